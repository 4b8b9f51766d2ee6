"""Removal of repeated passages by prefix-free parsing.

Of equal texts only the first is parsed; the others are repeated as a whole.
A rolling hash of the bytes sets the triggers: in every stretch of ``LENGTH``
bytes the smallest hash of a short gram. All stretches with the same trigger
form a phrase, so equal stretches begin at the same place of phrases with the
same trigger, and the corpus becomes a dictionary of phrases and, for every
document, the phrases it holds.

The order of the corpus is only needed up to ``LENGTH`` bytes: which stretches
are equal, and the smallest document of each. Both levels of it are sorted runs
of a distributed table. The parse is sorted by (trigger, phrase, document): a
phrase that a smaller document holds is repeated as a whole, and highly
repetitive text ends here. The suffixes of the dictionary, that is the stretches
of phrases that share their trigger with another phrase, are sorted by (trigger,
stretch, document), and those that a smaller document holds are repeated.
Phrases of a trigger of their own have no equal stretch and are never expanded.

On disk a byte of text costs most where it is hashed, so little is kept there at a
time: the parse is sorted for one share of the triggers after the other, shared
phrases move as their bytes and are hashed where they are compared, and what a
step has written goes when its result is there.

Triggers that hold a large share of the parse are found first, by counts that
every task keeps of its most frequent ones. Their rows are sorted in runs that may
be cut anywhere, also within equal rows of different documents; what a run hands
to the next is its last key. All others are sorted where their trigger is.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortline.llm.common import settle, settled_alone, small_enough, table

LENGTH = 50
GRAM = 16
# A trigger is hot when it may hold this share of the parse.
HOT_SHARE = 1 / 2_000
# Triggers that a task keeps counts of: what it loses of one is at most a quarter of that share.
_COUNTED = 4 * 2_000
# Shares of the triggers whose parse is sorted one after the other.
SHARES = 2
# Bytes that are parsed at a time.
_SLICE = 1 << 20
# Stretches that are compared at a time.
_COMPARED = 1 << 22
_BITS = 24

_rng = np.random.default_rng(50)
_BYTES = _rng.integers(0, 1 << 64, 256, dtype=np.uint64, endpoint=False)
_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base modulo 2**64 and their inverses; kept for slices of the usual size."""
    size = max(size, 2 * _SLICE)
    if size not in _powers:
        _powers.clear()
        up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers[size] = np.cumprod(up), np.cumprod(down)
    return _powers[size]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _running(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of the weighted bytes, and the inverse powers that move a sum to the front."""
    up, down = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    return sums, down


def _ranges(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges one after the other, and where each range begins and ends among them."""
    ends = np.cumsum(np.concatenate([[0], size]))
    return np.arange(ends[-1]) + np.repeat(start - ends[:-1], size), ends


class Parse:
    """Phrases of a slice of documents, as positions in its bytes and hashes."""

    def __init__(self, texts: list[bytes]) -> None:
        data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(sizes) - sizes
        self.data = data
        self._sums, self._down = _running(data)
        counts = np.maximum(sizes - LENGTH + 1, 0)
        # Where stretches begin, and the document of each.
        total = int(counts.sum())
        self.row = np.repeat(np.arange(len(texts)), counts)
        self.at = np.arange(total) + np.repeat(self.starts - (np.cumsum(counts) - counts), counts)
        empty = np.empty(0, np.int64)
        if not total:
            self.first = self.last = self.phrase_row = empty
            self.trigger = self.phrase = empty.astype(np.uint64)
            return
        low = np.uint64((1 << _BITS) - 1)
        grams = _mix((self._sums[GRAM:] - self._sums[:-GRAM]) * self._down[: len(data) - GRAM + 1] + np.uint64(GRAM))
        least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        # Smallest gram of the stretch at each position, the leftmost of equals.
        span, wanted = 1, LENGTH - GRAM + 1
        while span < wanted:
            step = min(span, wanted - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        place = (least[self.at] & low).astype(np.int64)
        new = np.empty(total, bool)
        new[0] = True
        new[1:] = (place[1:] != place[:-1]) | (self.row[1:] != self.row[:-1])
        begin = np.flatnonzero(new)
        self.first, self.last = begin, np.append(begin[1:], total) - 1
        self.phrase_row = self.row[begin]
        self.trigger = grams[place[begin]]
        start = self.at[begin]
        self.phrase = _mix(self._hash(start, self.at[self.last] + LENGTH - start))

    def _hash(self, start: np.ndarray, size: int | np.ndarray) -> np.ndarray:
        """Polynomial hash of the bytes from ``start``; equal for equal bytes."""
        return (self._sums[start + size] - self._sums[start]) * self._down[start] + np.asarray(size, np.uint64)

    def stretches(self) -> np.ndarray:
        """Hash of the stretch at each position of ``at``."""
        return _mix(self._hash(self.at, LENGTH))


def _pieces(text: bytes) -> list[bytes]:
    """Overlapping pieces of a text such that every stretch begins in exactly one."""
    if len(text) <= _SLICE:
        return [text]
    return [text[i : i + _SLICE + LENGTH - 1] for i in range(0, len(text) - LENGTH + 1, _SLICE)]


def _slices(part: pa.RecordBatch, wanted: np.ndarray | None = None) -> Iterator[tuple[list[int], list[bytes]]]:
    """Rows and texts of slices of about ``_SLICE`` bytes; a long text gives several pieces."""
    rows, texts, size = [], [], 0
    for row, text in enumerate(part["text"]):
        if wanted is not None and not wanted[row]:
            continue
        for piece in _pieces((text.as_py() or "").encode("utf-8", "replace")):
            rows.append(row)
            texts.append(piece)
            size += len(piece)
            if size >= _SLICE:
                yield rows, texts
                rows, texts, size = [], [], 0
    if rows:
        yield rows, texts


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc, text``; rows without an id count as behind all others."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"), "text")


def parse(texts: DataFrame, only: list[int] | None = None, share: tuple[int, int] = (0, 1)) -> DataFrame:
    """``trigger, phrase, doc``: the distinct phrases of every text, or those of the triggers in ``only``.

    ``share`` is the remainder of the triggers by a number of shares.
    """
    wanted = None if only is None else np.array(only, np.int64)
    place, shares = map(np.uint64, share)

    def phrases(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids = part["doc"].to_numpy()
            for rows, pieces in _slices(part):
                found = Parse(pieces)
                doc, trigger, phrase = ids[np.array(rows)[found.phrase_row]], found.trigger, found.phrase
                if wanted is not None:
                    own = np.isin(trigger.view(np.int64), wanted)
                    doc, trigger, phrase = doc[own], trigger[own], phrase[own]
                if shares > 1:
                    own = trigger % shares == place
                    doc, trigger, phrase = doc[own], trigger[own], phrase[own]
                order = np.lexsort((phrase, trigger, doc))
                doc, trigger, phrase = doc[order], trigger[order], phrase[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (trigger[1:] != trigger[:-1]) | (phrase[1:] != phrase[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(trigger[new].view(np.int64)), pa.array(phrase[new].view(np.int64)), pa.array(doc[new])],
                    ["trigger", "phrase", "doc"],
                )

    return texts.mapInArrow(phrases, "trigger long, phrase long, doc long")


def _merged(trigger: np.ndarray, n: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts by trigger, all lowered by the largest that does not fit into ``most``."""
    trigger, at = np.unique(trigger, return_inverse=True)
    n = np.bincount(at, n, len(trigger)).astype(np.int64)
    if len(n) > most:
        n = n - np.partition(n, len(n) - most - 1)[len(n) - most - 1]
    return trigger[n > 0], n[n > 0]


def hot_triggers(texts: DataFrame) -> list[int]:
    """All triggers with ``HOT_SHARE`` of the phrases of all texts, and none with less than half of it."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, trigger, n = 0, np.empty(0, np.int64), np.empty(0, np.int64)
        for part in parts:
            for _, pieces in _slices(part):
                own = Parse(pieces).trigger.view(np.int64)
                total += len(own)
                trigger, n = _merged(np.append(trigger, own), np.append(n, np.ones(len(own), np.int64)), _COUNTED)
        # Null stands for all triggers.
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *trigger.tolist()], pa.int64()), pa.array([total, *n.tolist()], pa.int64())], ["trigger", "n"]
        )

    counts = settle(texts.mapInArrow(count, "trigger long, n long").groupBy("trigger").agg(F.sum("n").alias("n")))
    total = counts.filter("trigger is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # Each task may have lost a quarter of the share of its own phrases.
    return [r.trigger for r in counts.filter((F.col("trigger").isNotNull()) & (F.col("n") >= 0.75 * HOT_SHARE * total)).collect()]


def later_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows ``keys, doc`` with ``later``: whether a smaller document has the same keys, which are whole numbers.

    The rows are sorted in runs that may be cut anywhere between documents, so equal
    keys of any number are dealt evenly. The driver sees two rows of a run.
    """

    def mark(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_id = TaskContext.get().partitionId()
        last, least, edge = None, 0, True
        for part in parts:
            if not part.num_rows:
                continue
            columns = [part[k].to_numpy() for k in keys]
            doc = part["doc"].to_numpy()
            new = np.ones(len(doc), bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            first = tuple(int(c[0]) for c in columns)
            new[0] = first != last
            begin = np.maximum.accumulate(np.where(new, np.arange(len(doc)), -1))
            smallest = np.where(begin >= 0, doc[begin], least)
            # Equal keys before the first change go on from the run before.
            if last is None:
                new[0] = False
            at_edge = (np.cumsum(new) == 0) & edge
            edge = bool(at_edge[-1])
            last, least = tuple(int(c[-1]) for c in columns), smallest[-1]
            yield pa.RecordBatch.from_arrays(
                [*[part[k] for k in keys], part["doc"], pa.array(doc > smallest), pa.array(at_edge),
                 pa.array(np.full(len(doc), part_id, np.int32))],
                [*keys, "doc", "later", "edge", "run"],
            )

    schema = ", ".join(f"{k} long" for k in keys) + ", doc long, later boolean, edge boolean, run int"
    order = [*keys, "doc"]
    runs = settle(rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(mark, schema))
    key = F.struct(*keys)
    ends = runs.groupBy("run").agg(F.min(key).alias("first"), F.max(key).alias("last")).orderBy("run").collect()
    # Equal rows are in one run, so all documents of a key that goes on are behind those before.
    goes_on = [b.run for a, b in zip(ends, ends[1:], strict=False) if a["last"] == b["first"]]
    later = F.col("later") | (F.col("edge") & F.col("run").isin(goes_on)) if goes_on else F.col("later")
    return runs.select(*order, later.alias("later"))


def repeated_phrases(texts: DataFrame) -> tuple[DataFrame, list[int]]:
    """``doc, phrase, whole`` and the hot triggers.

    ``whole`` phrases are in a smaller document too. The others are the first of
    their kind, and share their trigger with another phrase.
    """
    hot = hot_triggers(texts)
    known = F.col("trigger").isin(hot) if hot else F.lit(False)
    by_phrase, by_trigger = Window.partitionBy("trigger", "phrase"), Window.partitionBy("trigger")
    whole = F.col("doc") > F.col("least")
    every = [
        settle(
            parse(texts, share=(share, SHARES)).filter(~known)
            .repartition("trigger")
            .withColumn("least", F.min("doc").over(by_phrase))
            .withColumn("shared", F.min("phrase").over(by_trigger) != F.max("phrase").over(by_trigger))
            .filter(whole | F.col("shared"))
            .select("doc", "phrase", whole.alias("whole"))
        )
        for share in range(SHARES)
    ]
    if hot:

        def warm() -> DataFrame:
            rows = later_rows(settle(parse(texts, hot)), ["trigger", "phrase"])
            return rows.select("doc", "phrase", F.col("later").alias("whole"))

        every.append(settled_alone(texts.sparkSession, warm))
    return reduce(DataFrame.unionByName, every), hot


def _stretches(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all stretches of phrases of some sizes that lie one after the other, and the phrase of each."""
    sums, down = _running(data)
    at, ends = _ranges(np.cumsum(sizes) - sizes, sizes - LENGTH + 1)
    hashes = _mix((sums[at + LENGTH] - sums[at]) * down[at] + np.uint64(LENGTH))
    return hashes.view(np.int64), np.repeat(np.arange(len(sizes)), np.diff(ends))


def _bytes_of(bodies: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column, and the size of every entry."""
    bodies = bodies.cast(pa.binary())
    offsets = np.frombuffer(bodies.buffers()[1], np.int32)[bodies.offset : bodies.offset + len(bodies) + 1]
    return np.frombuffer(bodies.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], np.diff(offsets).astype(np.int64)


def _later_stretches(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc, stretch`` that a smaller document holds, among all phrases ``trigger, doc, body`` of some triggers."""
    total = sum(int((_bytes_of(p["body"])[1] - LENGTH + 1).sum()) for p in parts)
    # The stretches of very many phrases are compared class by class.
    classes = 1 + total // _COMPARED
    for k in range(classes):
        found = []
        for part in parts:
            hashes, row = _stretches(*_bytes_of(part["body"]))
            if classes > 1:
                mine = hashes.view(np.uint64) % np.uint64(classes) == k
                hashes, row = hashes[mine], row[mine]
            found.append((part["trigger"].to_numpy()[row], hashes, part["doc"].to_numpy()[row]))
        trigger, stretch, doc = (np.concatenate(x) for x in zip(*found, strict=True))
        if not len(doc):
            continue
        order = np.lexsort((stretch, trigger))
        trigger, stretch, doc = trigger[order], stretch[order], doc[order]
        new = np.ones(len(doc), bool)
        new[1:] = (stretch[1:] != stretch[:-1]) | (trigger[1:] != trigger[:-1])
        least = np.minimum.reduceat(doc, np.flatnonzero(new))
        later = doc > least[np.cumsum(new) - 1]
        yield pa.RecordBatch.from_arrays([pa.array(doc[later]), pa.array(stretch[later])], ["doc", "stretch"])


def _by_trigger(parts: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Batches sorted by trigger, cut so that all rows of a trigger come together."""
    held: list[pa.RecordBatch] = []
    for part in parts:
        if not part.num_rows:
            continue
        trigger = part["trigger"].to_numpy()
        last = int(np.searchsorted(trigger, trigger[-1]))
        if last or (held and held[-1]["trigger"][0] != part["trigger"][0]):
            held.append(part.slice(0, last))
            yield [p for p in held if p.num_rows]
            held = []
        held.append(part.slice(last))
    if held:
        yield held


def repeated_stretches(texts: DataFrame, shared: DataFrame, hot: list[int]) -> DataFrame:
    """``doc, stretches``: hashes of stretches of shared phrases that a smaller document holds."""
    wanted = shared.groupBy("doc").agg(F.collect_set("phrase").alias("phrases"))

    def expand(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, lists = part["doc"].to_numpy(), part["phrases"]
            for rows, pieces in _slices(part):
                found = Parse(pieces)
                keep = np.zeros(len(found.phrase), bool)
                edges = np.searchsorted(found.phrase_row, np.arange(len(rows) + 1))
                for i, row in enumerate(rows):
                    own = found.phrase[edges[i] : edges[i + 1]]
                    keep[edges[i] : edges[i + 1]] = np.isin(own.view(np.int64), lists[row].values.to_numpy())
                kept = np.flatnonzero(keep)
                start = found.at[found.first[kept]]
                index, ends = _ranges(start, found.at[found.last[kept]] + LENGTH - start)
                bodies = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(found.data[index])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.trigger[kept].view(np.int64)),
                        pa.array(ids[np.array(rows, np.int64)[found.phrase_row[kept]]]),
                        pa.Array.from_buffers(pa.binary(), len(kept), bodies),
                    ],
                    ["trigger", "doc", "body"],
                )

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _by_trigger(parts):
            yield from _later_stretches(group)

    def hashed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            stretch, row = _stretches(*_bytes_of(part["body"])) if part.num_rows else (np.empty(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays(
                [part["trigger"].take(pa.array(row)), part["doc"].take(pa.array(row)), pa.array(stretch)],
                ["trigger", "doc", "stretch"],
            )

    def later() -> DataFrame:
        expanded = settle(texts.join(wanted, "doc").mapInArrow(expand, "trigger long, doc long, body binary"))
        known = F.col("trigger").isin(hot) if hot else F.lit(False)
        # Phrases move whole, and are expanded where their trigger is.
        rows = (
            expanded.filter(~known).repartition("trigger").sortWithinPartitions("trigger")
            .mapInArrow(compare, "doc long, stretch long")
        )
        if hot:
            warm = expanded.filter(known).mapInArrow(hashed, "trigger long, doc long, stretch long")
            rows = rows.unionByName(later_rows(warm, ["trigger", "stretch"]).filter("later").select("doc", "stretch"))
        return rows

    found = settled_alone(texts.sparkSession, later)
    return found.groupBy("doc").agg(F.collect_set("stretch").alias("stretches"))


def _removed(part: pa.RecordBatch, phrases: list[np.ndarray], stretches: list[np.ndarray]) -> dict[int, np.ndarray]:
    """Masks of the bytes that go, by row, for the rows that lose any; rows name their phrases and stretches."""
    wanted = np.array([len(a) + len(b) > 0 for a, b in zip(phrases, stretches, strict=True)])
    masks: dict[int, np.ndarray] = {}
    pieces_of: Counter[int] = Counter()
    for rows, pieces in _slices(part, wanted):
        found = Parse(pieces)
        hashes = found.stretches().view(np.int64) if any(len(stretches[r]) for r in rows) else None
        by_phrase = np.searchsorted(found.phrase_row, np.arange(len(rows) + 1))
        by_stretch = np.searchsorted(found.row, np.arange(len(rows) + 1))
        begins, ends = [], []
        for i, row in enumerate(rows):
            own = slice(by_phrase[i], by_phrase[i + 1])
            hit = np.flatnonzero(np.isin(found.phrase[own].view(np.int64), phrases[row])) + own.start
            begins.append(found.at[found.first[hit]])
            ends.append(found.at[found.last[hit]] + LENGTH)
            if len(stretches[row]):
                own = slice(by_stretch[i], by_stretch[i + 1])
                at = found.at[own][np.isin(hashes[own], stretches[row])]
                begins.append(at)
                ends.append(at + LENGTH)
        size = sum(map(len, pieces)) + 1
        change = np.bincount(np.concatenate(begins), minlength=size) - np.bincount(np.concatenate(ends), minlength=size)
        gone = np.cumsum(change) > 0
        for row, piece, start in zip(rows, pieces, found.starts.tolist(), strict=True):
            offset = pieces_of[row] * _SLICE
            pieces_of[row] += 1
            mine = gone[start : start + len(piece)]
            if mine.any():
                if row not in masks:
                    masks[row] = np.zeros(len(part["text"][row].as_py().encode("utf-8", "replace")), bool)
                masks[row][offset : offset + len(piece)] |= mine
    return masks


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept``.

    ``docs`` needs ``doc_id``, a whole number, and ``text``; other columns are
    ignored. A byte goes when a stretch of ``LENGTH`` bytes over it also begins
    in a document with a smaller id; rows of one id do not remove each other, and
    rows without an id come last. ``kept`` holds the other bytes in order. Null
    counts as empty; repeated rows give repeated results.
    """
    every = _keyed(docs)
    # A text that a smaller document holds whole goes whole; only the first of equal texts is parsed.
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    copies = settle(
        every.groupBy(digest.alias("copy")).agg(F.min("doc").alias("least"), F.max("doc").alias("last"))
        .filter("least < last").drop("last")
    )
    few = F.broadcast(copies) if small_enough(copies, 128) else copies
    marked = every.withColumn("copy", digest).join(few, "copy", "left")
    again = F.coalesce(F.col("doc") > F.col("least"), F.lit(False))
    texts = marked.filter(~again).select("doc", "text")
    found, hot = repeated_phrases(texts)
    phrases = found.filter("whole").groupBy("doc").agg(F.collect_set("phrase").alias("phrases"))
    stretches = repeated_stretches(texts, found.filter("not whole"), hot)

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        for part in parts:
            lists = [
                [x.values.to_numpy() if x.is_valid else none for x in part[name]] for name in ("phrases", "stretches")
            ]
            masks = _removed(part, *lists)
            out: list[list] = [[], [], [], []]
            for row, text in enumerate(part["text"]):
                data = (text.as_py() or "").encode("utf-8", "replace")
                kept, gone, spans = data, 0, 0
                if row in masks:
                    mask = masks[row]
                    kept = np.frombuffer(data, np.uint8)[~mask].tobytes()
                    gone = int(mask.sum())
                    spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
                for held, value in zip(out, (len(data), gone, spans, kept), strict=True):
                    held.append(value)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [part["doc"], *[pa.array(h, t) for h, t in zip(out, types, strict=True)]],
                ["doc", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    parsed = texts.join(phrases, "doc", "left").join(stretches, "doc", "left")
    schema = "doc long, n_bytes long, n_removed long, n_spans long, kept binary"
    data = F.coalesce("text", F.lit("")).cast("binary")
    size, whole = F.octet_length(data).cast("long"), F.octet_length(data) >= LENGTH
    repeated = marked.filter(again).select(
        "doc", size.alias("n_bytes"), F.when(whole, size).otherwise(0).alias("n_removed"),
        whole.cast("long").alias("n_spans"), F.when(whole, F.lit(b"")).otherwise(data).alias("kept"),
    )
    own = F.when(F.col("doc") != (1 << 63) - 1, F.col("doc")).cast(docs.schema["doc_id"].dataType)
    done = parsed.mapInArrow(cut, schema).unionByName(repeated)
    return done.select(own.alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
