"""Exact deduplication by progressive refinement.

Rows are grouped by the length of the normalised text, then by the hash of its
first bytes, and only rows whose group still has company are read again and
hashed in full. Every grouping is a partial aggregate, so a text that fills a
third of the table is counted before anything moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm.common import small_enough, table
from cohortline.plans.durable import freeze

PREFIX = 128


def normalised(text: Column) -> Column:
    """Null as empty text; each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _shape(text: Column) -> list[Column]:
    return [
        F.octet_length(text).alias("size"),
        F.xxhash64(F.substring(text, 1, PREFIX)).alias("prefix"),
    ]


def exact_duplicates(docs: DataFrame, digest: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Of equal
    texts the row with the smallest ``doc_id`` stays; null ids come last, and of
    repeated rows with that id one stays. ``text_sha256`` is null for texts that
    the length or prefix already showed to be alone, unless ``digest`` asks for
    all of them. An empty table gives an empty result.
    """
    texts = docs.select("doc_id", normalised(F.col("text")).alias("text"))
    shaped = texts.select("doc_id", "text", *_shape(F.col("text")))
    # Rows of one shape are counted where they are read, so copies move as one row.
    shapes = freeze(shaped.groupBy("size", "prefix").agg(F.count("*").alias("n")))
    lengths = shapes.groupBy("size").agg(F.sum("n").alias("rows")).filter("rows > 1")
    crowds = freeze(
        shapes.join(lengths, "size", "left_semi").filter("n > 1").select(
            F.col("size").alias("c_size"), F.col("prefix").alias("c_prefix")
        )
    )
    near = F.broadcast(crowds) if small_enough(crowds, 32) else crowds
    match = (F.col("size") == F.col("c_size")) & (F.col("prefix") == F.col("c_prefix"))
    full = F.sha2("text", 256)
    alone = shaped.join(near, match, "left_anti").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        (full if digest else F.lit(None).cast("string")).alias("text_sha256"),
    )
    hashed = shaped.join(near, match, "left_semi").select("doc_id", full.alias("text_sha256"))
    # Repeated rows of one id count here and come back at the end.
    rows = freeze(hashed.groupBy("text_sha256", "doc_id").agg(F.count("*").alias("copies")))
    groups = rows.groupBy("text_sha256").agg(
        F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")
    )
    several = rows.join(groups, "text_sha256").select(
        "doc_id",
        "keep_id",
        "group_size",
        "text_sha256",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    )
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return alone.unionByName(several.withColumn("kept", kept).drop("copy"))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    decided = freeze(exact_duplicates(docs).filter("text_sha256 is not null"))
    dropped = decided.filter("not kept").select("doc_id", "text_sha256", "keep_id").distinct()
    digest = F.sha2(normalised(docs["text"]), 256)
    gone = dropped.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    key = docs["doc_id"].eqNullSafe(gone["doc_id"]) & (digest == gone["text_sha256"])
    left = docs.join(F.broadcast(gone) if small_enough(gone, 128) else gone, key, "left_anti")
    repeated = dropped.filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    if repeated.isEmpty():
        return left
    key = docs["doc_id"].eqNullSafe(repeated["doc_id"]) & (digest == repeated["text_sha256"])
    single = left.join(repeated, key, "left_anti")
    # Only the rows that share their id and their text with another row move.
    name = "digest"
    while name in docs.columns:
        name += "_"
    one = left.join(repeated, key, "left_semi").withColumn(name, F.sha2(normalised(F.col("text")), 256))
    return single.unionByName(one.dropDuplicates(["doc_id", name]).drop(name))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), digest=True)


SQL = r"""
WITH texts AS (
    SELECT doc_id,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id, min(doc_id) OVER same_text AS keep_id, count(*) OVER same_text AS group_size,
       doc_id = min(doc_id) OVER same_text AS kept, text_sha256
FROM texts
WINDOW same_text AS (PARTITION BY text_sha256)
"""
