"""Benchmark decontamination with a broadcast hash set of n-grams.

Native Spark expressions only. Each text becomes an array of words; the hashes
of its windows are exploded, without the words, into a broadcast hash join with
the distinct windows of the benchmark. Texts with hits are read once more, and
every hit is verified word by word against its text before it counts. The work
is in proportion to the words of a text, however long it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm.common import BROADCAST_BYTES, lower_ascii, small_enough, table
from cohortline.plans.durable import freeze
from cohortline.plans.skew import table_bytes

WINDOW = 10
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased words of a text; none for null."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), _GAP)
    return F.filter(parts, lambda w: w != "")


def _windows(tokens: Column, size: Column) -> Column:
    """``(at, size, hash)`` of every run of ``size`` words."""
    last = F.size(tokens) - size
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        starts,
        lambda at: F.struct(
            at.alias("at"), size.alias("size"), F.xxhash64(F.slice(tokens, at + 1, size)).alias("hash")
        ),
    )


def benchmark_windows(benchmark: DataFrame, width: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The distinct windows ``(gram, hash, size, words)`` and the items of each ``(gram, item_id)``."""
    items = benchmark.select("item_id", words(F.col("text")).alias("tokens")).filter(F.size("tokens") > 0)
    size = F.least(F.size("tokens"), F.lit(width))
    cut = items.select(
        "item_id", "tokens", F.explode(_windows(F.col("tokens"), size)).alias("w")
    ).select("item_id", "w.hash", "w.size", F.slice("tokens", F.col("w.at") + 1, F.col("w.size")).alias("words"))
    named = cut.withColumn("gram", F.sha2(F.concat_ws(" ", "words"), 256)).distinct()
    named = freeze(named)
    return named.select("gram", "hash", "size", "words").distinct(), named.select("gram", "item_id").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    ``docs`` needs ``doc_id`` and ``text``, ``benchmark`` needs ``item_id`` and
    ``text``; other columns are ignored. Null and empty texts have no words and
    no hits; items without words are ignored. Repeated rows give repeated
    results, empty tables none, an empty benchmark no hits.
    """
    grams, owners = benchmark_windows(benchmark, width)
    grams, owners = freeze(grams), freeze(owners)
    sizes = sorted(r[0] for r in grams.select("size").distinct().collect())  # at most ``width`` numbers
    rows = docs.select("doc_id", F.xxhash64("text").alias("copy"), F.col("text").alias("text"))
    tokens = words(F.col("text"))
    parted = rows.withColumn("tokens", tokens)
    # The first element stands for the row itself and holds its size, so that one pass serves all.
    row = F.struct(F.lit(-1).alias("at"), F.size("tokens").alias("size"), F.lit(0).cast("long").alias("hash"))
    all_windows = F.concat(F.array(row), *[_windows(F.col("tokens"), F.lit(s)) for s in sizes])
    spread = parted.select("doc_id", "copy", F.explode(all_windows).alias("w"))
    small = F.broadcast(grams) if table_bytes(grams) <= BROADCAST_BYTES else grams
    small = small.select("gram", F.col("hash").alias("g_hash"), F.col("size").alias("g_size"), "words")
    same = (F.col("w.hash") == F.col("g_hash")) & (F.col("w.size") == F.col("g_size")) & (F.col("w.at") >= 0)
    itself = F.col("w.at") < 0
    found = (
        spread.join(small, same, "left")
        .filter(itself | F.col("gram").isNotNull())
        .select(
            "doc_id",
            "copy",
            F.when(itself, F.col("w.size")).alias("n_words"),
            F.when(~itself, F.struct("w.at", "w.size", "gram", "words")).alias("hit"),
        )
    )
    # One group is one text: its hits are bounded by its words.
    texts = freeze(
        found.groupBy("doc_id", "copy").agg(
            F.max("n_words").cast("long").alias("n_words"),
            F.count("n_words").alias("copies"),
            F.sort_array(F.collect_set("hit")).alias("hits"),
        )
    )
    marked = texts.filter(F.size("hits") > 0).select(
        F.col("doc_id").alias("m_doc"), F.col("copy").alias("m_copy"), "n_words", "hits"
    )
    marked = freeze(marked)
    few = F.broadcast(marked) if table_bytes(marked) <= BROADCAST_BYTES else marked
    met = F.col("doc_id").eqNullSafe(F.col("m_doc")) & (F.col("copy") == F.col("m_copy"))
    # Every row with hits is read again with its words; repeated rows come as often as they are.
    again = rows.join(few, met).withColumn("tokens", tokens)
    true = F.filter("hits", lambda h: F.slice("tokens", h["at"] + 1, h["size"]) == h["words"])
    verified = again.select(
        "doc_id", "copy", "n_words", F.lit(1).cast("long").alias("copies"), true.alias("hits")
    )
    clean = texts.filter(F.size("hits") == 0)
    texts = freeze(
        verified.unionByName(clean).select(
            "doc_id", "copy", "n_words", "copies",
            F.array_sort(F.array_distinct(F.transform("hits", lambda h: F.struct(h["at"].alias("at"), h["size"].alias("size"))))).alias("spans"),
            F.array_distinct(F.transform("hits", lambda h: h["gram"])).alias("grams"),
        )
    )
    end = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("end"))
    covered = F.aggregate(
        "spans",
        end,
        lambda a, s: F.struct(
            (a["hit"] + F.greatest(s["at"] + s["size"] - F.greatest(s["at"], a["end"]), F.lit(0))).alias("hit"),
            F.greatest(a["end"], s["at"] + s["size"]).alias("end"),
        ),
    )["hit"]
    few_owners = F.broadcast(owners) if small_enough(owners, 96) else owners
    items = (
        texts.filter(F.size("grams") > 0)
        .select("doc_id", "copy", F.explode("grams").alias("gram"))
        .join(few_owners, "gram")
        .distinct()
        .groupBy(F.col("doc_id").alias("i_doc"), F.col("copy").alias("i_copy"))
        .agg(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit(""))).alias("items"))
    )
    ids = F.coalesce("items", F.array().cast("array<string>"))
    pair = F.col("doc_id").eqNullSafe(F.col("i_doc")) & (F.col("copy") == F.col("i_copy"))
    return (
        texts.withColumn("n_hit", covered)
        .join(items, pair, "left")
        .select(
            "doc_id",
            "n_words",
            "n_hit",
            F.size(ids).cast("long").alias("n_items"),
            F.sha2(F.array_join(F.sort_array(ids), ","), 256).alias("items_sha256"),
            (F.col("n_hit") > 0).alias("contaminated"),
            "copy",
            F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("nth"),
        )
        .drop("nth")
        .withColumnRenamed("copy", "text_hash")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without a benchmark window, with all their columns."""
    found = contamination(docs, benchmark, width).filter("contaminated")
    gone = freeze(found.select(F.col("doc_id").alias("g_id"), F.col("text_hash").alias("g_hash")).distinct())
    match = docs["doc_id"].eqNullSafe(gone["g_id"]) & (F.xxhash64(docs["text"]) == gone["g_hash"])
    return docs.join(F.broadcast(gone) if small_enough(gone, 24) else gone, match, "left_anti")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contamination(docs, benchmark).drop("text_hash")


SQL = r"""
WITH doc AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM documents
), item AS (
    SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM benchmark
), item_window AS (
    SELECT DISTINCT item_id, least(len(words), 10) AS size,
           array_to_string(words[pos : pos + least(len(words), 10) - 1], ' ') AS gram
    FROM (SELECT item_id, words, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS pos
          FROM item WHERE len(words) > 0)
), doc_window AS (
    SELECT doc_id, pos, size, array_to_string(words[pos : pos + size - 1], ' ') AS gram
    FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos
          FROM doc, (SELECT DISTINCT size FROM item_window))
), hit AS (
    SELECT doc_id, pos, d.size, item_id FROM doc_window d JOIN item_window i USING (gram)
    WHERE d.size = i.size
), place AS (
    SELECT DISTINCT doc_id, unnest(range(pos, pos + size)) AS word FROM hit
), hits AS (
    SELECT doc_id, count(*) AS n_hit FROM place GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""
