"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into ``(bits + 2) // 2`` segments, so of two
fingerprints within ``bits`` differing bits one segment differs in at most one.
Every segment is indexed once per position with that bit deleted, and only
fingerprints that share a variant with another one go on. Fingerprints are
collapsed first, so copies of one text never meet each other.

These candidates are joined on whole fingerprints with ``bits // 2`` bits turned
(and one more deleted where ``bits`` is odd): two of them within the distance
have a point half-way in common, and all that have one are within the distance.
Such a class is bounded by the number of points around one, whatever the size of
a group, so links are given as a star in each class and no pairs are formed.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm.common import small_enough, table
from cohortline.llm.graph import components
from cohortline.plans.durable import freeze

SHINGLE = 3
BITS = 2
_BLOCK = 1 << 15


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of the ``width``-word shingles of a text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    total = max(len(words) - width + 1, 1)
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, total, _BLOCK):
        block = words[start : min(start + _BLOCK, total) + width - 1]
        shingles = zip(*(block[i:] for i in range(min(width, len(words)))), strict=False)
        hashes = np.fromiter((digest(b" ".join(s), 42) for s in shingles), np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += np.add.reduce(bits, axis=0, dtype=np.uint16)
    return int(np.packbits(votes * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """``doc_id, copy, fp``: a hash of the text and its fingerprint, as signed longs, of every row."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64))

    return docs.select("doc_id", F.xxhash64("text").alias("copy"), of(F.col("text")).alias("fp"))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _variants(points: DataFrame, masks: list[int]) -> DataFrame:
    """Every fingerprint once per mask, with the masked bits kept."""
    kept = F.array(*[F.lit(_signed(m)).cast("long") for m in masks])
    spread = points.select("fp", F.posexplode(kept).alias("mask", "bits"))
    return spread.select("fp", "mask", F.col("fp").bitwiseAND(F.col("bits")).alias("key"))


def _turns(bits: int) -> list[tuple[int, int]]:
    """Bits that are kept and bits that are turned, so that points within ``bits`` of each other meet.

    After one deletion for an odd distance the rest is even, and half of it leads to a middle.
    """
    everything = (1 << 64) - 1
    masks = [everything & ~(1 << b) for b in range(64)] if bits % 2 else [everything]
    turned = [sum(1 << b for b in some) for k in range(bits // 2 + 1) for some in combinations(range(64), k)]
    return [(m, t) for m in masks for t in turned if t & m == t]


def near_links(points: DataFrame, bits: int = BITS) -> DataFrame:
    """Distinct links ``(u, v)`` that connect whatever is within ``bits`` differing bits.

    ``points`` holds distinct fingerprints in column ``fp``. Every link is within
    the distance, and any two points within it have a path of links in their class.
    """
    segments = (bits + 2) // 2
    cuts = [64 * s // segments for s in range(segments + 1)]
    masks = [
        ((1 << hi) - (1 << lo)) & ~(1 << wild)
        for lo, hi in zip(cuts, cuts[1:], strict=False)
        for wild in range(lo, hi)
    ]
    index = _variants(points, masks)
    shared = freeze(index.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1").drop("n"))
    met = index.join(F.broadcast(shared) if small_enough(shared, 40) else shared, ["mask", "key"], "left_semi")
    candidates = freeze(met.select("fp").distinct())
    turns = F.array(
        *[F.struct(F.lit(_signed(m)).cast("long").alias("kept"), F.lit(_signed(t)).cast("long").alias("turned")) for m, t in _turns(bits)]
    )
    around = candidates.select("fp", F.explode(turns).alias("t")).select(
        "fp", F.col("t.kept").alias("kept"),
        F.col("fp").bitwiseAND(F.col("t.kept")).bitwiseXOR(F.col("t.turned")).alias("key"),
    )
    # A class lies within ``bits // 2`` of its key, so its members are few.
    classes = around.groupBy("kept", "key").agg(F.collect_list("fp").alias("members")).filter(F.size("members") > 1)
    stars = classes.select(F.explode("members").alias("u"), F.array_min("members").alias("v"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= bits
    return stars.filter("u <> v").filter(near).distinct()


def simhash_groups(docs: DataFrame, width: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Null and
    empty texts have fingerprint zero and are linked like any other. Texts of
    fewer words than ``width`` have one shingle. ``component_id`` is the smallest
    id that can be reached, null only where a component has no id at all.
    Repeated rows give repeated results; an empty table gives an empty result.
    """
    return _groups(docs, width, bits).drop("copy")


def _groups(docs: DataFrame, width: int, bits: int) -> DataFrame:
    marked = freeze(fingerprints(docs, width))
    points = freeze(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = freeze(components(near_links(points.select("fp"), bits)).withColumnRenamed("u", "fp"))
    joined = roots.join(points, "fp")
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = joined.join(least, "root").select("fp", "component_id")
    alone = points.join(roots, "fp", "left_anti").select("fp", F.col("least").alias("component_id"))
    named = freeze(linked.unionByName(alone))
    shown = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return marked.join(named, "fp").select("doc_id", "copy", shown, "component_id")


def drop_near_duplicates(docs: DataFrame, width: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """The row with the smallest id of each component, with all its columns.

    Ids are taken to be unique, as they are after exact deduplication: rows that
    repeat the smallest id stay with it. Rows without an id stay only where their
    component has no id.
    """
    groups = _groups(docs, width, bits)
    dropped = groups.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    gone = freeze(dropped.select(F.col("doc_id").alias("g_id"), F.col("copy").alias("g_copy")).distinct())
    match = docs["doc_id"].eqNullSafe(gone["g_id"]) & (F.xxhash64(docs["text"]) == gone["g_copy"])
    return docs.join(F.broadcast(gone) if small_enough(gone, 24) else gone, match, "left_anti")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))
