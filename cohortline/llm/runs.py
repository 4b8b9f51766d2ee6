"""Periodic runs of words by the branching-tandem test on an enhanced suffix array.

A square ``aa`` is branching when the word behind it differs from the first word
of ``a``; every run ends with exactly one of them for each of its periods, and
all its other squares are rotations to the left. ``a`` then is the label of an
LCP interval of depth ``|a|``, and the two copies begin in different children of
it. So for each LCP interval and each suffix ``i`` in its smaller children, the
suffixes ``i + depth`` and ``i - depth`` are looked up in the inverse suffix
array: a square branches there if they lie in the interval and not in the child.
Leaving out the largest child keeps the look-ups within ``n log n``.

There is no tree: an interval is an entry of the LCP array with the nearest
smaller entries on both sides, and all entries of a slice of documents are worked
on side by side. Documents sort before words, so one array serves them all and no
interval spans two of them.

Only runs of at least ``EXPONENT`` periods count. For these ``a`` also begins one
and two periods before the branching square, which the inverse array answers as
well; squares without that are dropped before they are rotated.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm.common import table

LEAST, EXPONENT = 6, 4
# Words that are worked on at a time; a longer text is a slice of its own.
_SLICE = 1 << 18
# Look-ups that are expanded at a time.
_EXPANDED = 1 << 22


@dataclass
class SuffixArray:
    """Suffixes of all documents in order, ranks of the suffixes, and common lengths of neighbours."""

    order: np.ndarray
    rank: np.ndarray
    common: np.ndarray  # -1 between documents


def suffix_array(words: np.ndarray, doc: np.ndarray, end: np.ndarray) -> SuffixArray:
    """By prefix doubling; only suffixes that still tie are sorted again.

    ``words`` are numbers from 0, ``doc`` the document of each word in rising
    order, ``end`` the position behind that document.
    """
    n = len(words)
    order = np.lexsort((words, doc))
    # A rank is the place of the first suffix of a group of ties.
    new = np.ones(n, bool)
    new[1:] = (doc[order[1:]] != doc[order[:-1]]) | (words[order[1:]] != words[order[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels = []
    size, tied = 1, np.flatnonzero(~(new & np.append(new[1:], True)))
    while len(tied):
        suffixes = order[tied]
        levels.append((size, suffixes, rank[suffixes]))
        behind = suffixes + size
        inside = behind < end[suffixes]
        # A suffix that ends here comes before those that go on.
        following = np.where(inside, rank[np.where(inside, behind, 0)], -1)
        own = rank[suffixes]
        sort = np.lexsort((following, own))
        suffixes, own, following = suffixes[sort], own[sort], following[sort]
        order[tied] = suffixes
        first = np.ones(len(tied), bool)
        first[1:] = (own[1:] != own[:-1]) | (following[1:] != following[:-1])
        rank[suffixes] = np.maximum.accumulate(np.where(first, tied, 0))
        tied = tied[~(first & np.append(first[1:], True))]
        size *= 2
    # Common lengths by descending the levels: two suffixes agree on a level's
    # length if both were tied there under one rank.
    common = np.zeros(n, np.int64)
    left, right = order[:-1].copy(), order[1:].copy()
    of_level = np.full(n + 1, -1, np.int64)
    pairs = np.flatnonzero(doc[left] == doc[right])
    for size, suffixes, ranks in reversed(levels):
        of_level[suffixes] = ranks
        a, b = left[pairs], right[pairs]
        same = (of_level[a] == of_level[b]) & (of_level[a] >= 0)
        hit = pairs[same]
        # A text that ends has no words to go on with: its place stays on the limit.
        common[hit + 1] += size
        left[hit] += size
        right[hit] += size
        of_level[suffixes] = -1
        keep = (left[pairs] < end[order[pairs]]) & (right[pairs] < end[order[pairs]])
        pairs = pairs[keep]
    apart = np.flatnonzero(doc[order[1:]] != doc[order[:-1]]) + 1
    common[apart] = -1
    if n:
        common[0] = -1
    return SuffixArray(order, rank, common)


class _Minima:
    """Nearest smaller entries by a tree of block minima, for many places at once."""

    def __init__(self, values: np.ndarray) -> None:
        # What lies beyond the end is smaller than all; there is at least one such place.
        lowest = np.full(1 << len(values).bit_length(), -2, np.int64)
        lowest[: len(values)] = values
        self.levels = [lowest]
        while len(self.levels[-1]) > 1:
            self.levels.append(np.minimum(self.levels[-1][::2], self.levels[-1][1::2]))

    def before(self, at: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The last place before ``at`` with an entry below ``value``, which must exist."""
        return self._nearest(at, value, -1)

    def after(self, at: np.ndarray, value: np.ndarray) -> np.ndarray:
        return self._nearest(at, value, 1)

    def _nearest(self, at: np.ndarray, value: np.ndarray, side: int) -> np.ndarray:
        node, level = at.copy(), np.zeros(len(at), np.int64)
        climbing = np.arange(len(at))
        # Up, until the block beside holds a smaller entry.
        for k, lowest in enumerate(self.levels):
            if not len(climbing):
                break
            own = node[climbing]
            beside = own + side
            inside = (own % 2 == (1 if side < 0 else 0)) & (beside >= 0) & (beside < len(lowest))
            found = inside & (lowest[np.where(inside, beside, 0)] < value[climbing])
            node[climbing] = np.where(found, beside, own >> 1)
            level[climbing[found]] = k
            climbing = climbing[~found]
        if len(climbing):
            raise ValueError("no smaller entry")
        # Down, into the half that is nearer if it holds one.
        for k in range(len(self.levels) - 2, -1, -1):
            going = np.flatnonzero(level == k + 1)
            if not len(going):
                continue
            near = 2 * node[going] + (1 if side < 0 else 0)
            lower = self.levels[k][near] < value[going]
            node[going] = np.where(lower, near, near ^ 1)
            level[going] = k
        return node


def branching_squares(array: SuffixArray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of the branching squares that end runs of ``EXPONENT`` periods or more.

    ``begin`` and ``end`` are the bounds of the document of each position.
    """
    order, rank, common = array.order, array.rank, array.common
    n = len(order)
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    if not n:
        return none
    # A period has to fit into its document EXPONENT times.
    at = np.flatnonzero((common > 0) & (EXPONENT * common <= (end - begin)[order]))
    if not len(at):
        return none
    depth = common[at]
    minima = _Minima(common)
    low = minima.before(at, depth)
    high = minima.after(at, depth) - 1
    # The label begins at least EXPONENT times in such a run.
    wide = high - low + 1 >= EXPONENT
    at, depth, low, high = at[wide], depth[wide], low[wide], high[wide]
    # Entries of one interval in a row; its children lie between them.
    sort = np.lexsort((at, depth, low))
    at, depth, low, high = at[sort], depth[sort], low[sort], high[sort]
    if not len(at):
        return none
    first = np.ones(len(at), bool)
    first[1:] = (low[1:] != low[:-1]) | (depth[1:] != depth[:-1])
    last = np.append(first[1:], True)
    # Children: one before each entry, and one behind the last entry of an interval.
    child_from = np.concatenate([np.where(first, low, np.append(0, at[:-1])), at[last]])
    child_to = np.concatenate([at - 1, high[last]])
    number = np.cumsum(first) - 1
    owner = np.concatenate([number, number[last]])
    sizes = child_to - child_from + 1
    by_size = np.lexsort((sizes, owner))
    largest = np.append(owner[by_size][1:] != owner[by_size][:-1], True)
    small = by_size[~largest]
    interval_low, interval_high, interval_depth = low[first], high[first], depth[first]
    starts, periods = [], []
    # Every suffix of the smaller children, some at a time.
    ends = np.cumsum(sizes[small])
    done = 0
    while done < len(small):
        upto = max(int(np.searchsorted(ends, (ends[done - 1] if done else 0) + _EXPANDED, "right")), done + 1)
        part = small[done:upto]
        done = upto
        count = sizes[part]
        place = np.arange(int(count.sum())) + np.repeat(child_from[part] - (np.cumsum(count) - count), count)
        own = np.repeat(part, count)
        i = order[place]
        p = interval_depth[owner[own]]
        lo, hi = interval_low[owner[own]], interval_high[owner[own]]
        ahead = i + p
        ok = ahead < end[i]
        there = rank[np.where(ok, ahead, i)]
        ok &= (there >= lo) & (there <= hi) & ((there < child_from[own]) | (there > child_to[own]))
        back = i - p
        ok_back = back >= begin[i]
        there = rank[np.where(ok_back, back, i)]
        ok_back &= (there >= lo) & (there <= hi) & ((there < child_from[own]) | (there > child_to[own]))
        for chosen, start in ((ok, i), (ok_back, back)):
            s, q, a, b = start[chosen], p[chosen], lo[chosen], hi[chosen]
            # The label also begins one and two periods before the square.
            for k in range(1, EXPONENT - 1):
                earlier = s - k * q
                fits = earlier >= begin[s]
                there = rank[np.where(fits, earlier, s)]
                fits &= (there >= a) & (there <= b)
                s, q, a, b = s[fits], q[fits], a[fits], b[fits]
            starts.append(s)
            periods.append(q)
    both = np.unique(np.stack([np.concatenate(starts), np.concatenate(periods)]), axis=1)
    return both[0], both[1]


def _rotated(words: np.ndarray, start: int, period: int, begin: int) -> int:
    """How far to the left a square can be rotated: where its run begins."""
    step, at = 64, start
    while at > begin:
        low = max(begin, at - step)
        differ = np.flatnonzero(words[low:at] != words[low + period : at + period])
        if len(differ):
            return low + int(differ[-1]) + 1
        at, step = low, step * 2
    return at


def runs_of(words: np.ndarray, sizes: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Runs ``(start, length, period)`` of each document, by start and period.

    ``words`` holds the numbers of the words of all documents in a row. A run is
    a longest stretch with that smallest period, of at least ``LEAST`` words and
    ``EXPONENT`` periods.
    """
    found: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    first = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(sizes)), sizes)
    begin, end = first[doc], (first + sizes)[doc]
    starts, periods = branching_squares(suffix_array(words, doc, end), begin, end)
    stops = starts + 2 * periods
    ending: list[tuple[int, int]] = []  # runs that end where the last one did: period, length
    last = -1
    for k in np.lexsort((periods, stops)).tolist():
        start, period, stop = int(starts[k]), int(periods[k]), int(stops[k])
        if stop != last:
            ending, last = [], stop
        # A label that is itself a repetition belongs to the run of the shorter period.
        if any(period % q == 0 and length >= 2 * period for q, length in ending):
            continue
        at = _rotated(words, start, period, int(begin[start]))
        ending.append((period, stop - at))
        if stop - at >= max(LEAST, EXPONENT * period):
            own = int(doc[start])
            found[own].append((at - int(first[own]), stop - at, period))
    for own in found:
        own.sort(key=lambda r: (r[0], r[2]))
    return found


def planted(doc_id: int | None, n: int) -> np.ndarray:
    """Where the words of a document come from: one in ten is made periodic from some word on."""
    at = np.arange(n)
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        at[a:] = a + (at[a:] - a) % p
    return at


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()])


_RESULT = (
    "doc_id long, n_runs long, start long, length long, period long, runs array<struct<start:long,length:long,period:long>>, "
    "collapsed binary"
)


def _finished(held: list[tuple[int | None, list[bytes]]]) -> pa.RecordBatch:
    number: dict[bytes, int] = {}
    ids = [number.setdefault(w, len(number)) for _, words in held for w in words]
    sizes = np.array([len(words) for _, words in held], np.int64)
    found = runs_of(np.array(ids, np.int64), sizes)
    best = [min(own, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None)) for own in found]
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
    every = [[dict(zip(("start", "length", "period"), r)) for r in own] for own in found]
    columns = [
        pa.array([d for d, _ in held], pa.int64()),
        pa.array([len(own) for own in found], pa.int64()),
        *[pa.array([b[k] for b in best], pa.int64()) for k in range(3)],
        pa.array(every, kind),
        pa.array([_collapsed(words, own) for (_, words), own in zip(held, found)], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_runs", "start", "length", "period", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """``doc_id, n_runs, start, length, period, runs, collapsed`` of every row of ``docs``.

    ``docs`` needs ``doc_id``, a whole number, and ``text``; other columns are
    ignored. Words are what white space separates; null and empty texts have
    none, so no runs, four nulls and an empty ``collapsed``, the text without the
    words that a run repeats. ``start, length, period`` are the longest run's; of
    equally long ones the earliest counts, then the shortest period. ``plant``
    first makes some documents periodic by their id (null counts as empty text
    there). Repeated rows give repeated results; an empty table gives no rows.
    """

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            held, size = [], 0
            for doc, text in zip(part["doc_id"].to_pylist(), part["text"]):
                words = (text.as_py() or b"").split()
                if plant:
                    words = [words[i] for i in planted(doc, len(words)).tolist()]
                held.append((doc, words))
                size += len(words)
                if size >= _SLICE:
                    yield _finished(held)
                    held, size = [], 0
            if held:
                yield _finished(held)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(search, _RESULT)


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of runs, the longest one, and digests of all runs and of the collapsed text."""
    found = periodic_runs(table(spark, sf_dir, "documents"), plant=True)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.col("n_runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id", "n_runs", "start", "length", "period",
        F.expr("CAST(1000 * length DIV period AS BIGINT)").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
