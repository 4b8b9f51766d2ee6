"""Token ids in files of interleaved range-coded blocks.

A data set is a folder: ``table`` holds the shared frequency table, and files
``ids-<part>-<block>`` hold consecutive blocks of the token stream, so that names
in order give the ids in order. A file ends with its directory:

* file: block, block, ..., directory (JSON), directory length and crc32, ``MAGIC``
* block: words of the coder, checkpoint states, index of documents (deflated)

A block codes up to ``BLOCK`` ids with a static range asymmetric numeral system.
``LANES`` coder states take turns and share one stream of 32-bit words; blocks do
not depend on each other. Each ``STRIDE`` ids a checkpoint keeps the states and
the place in the stream, so a reader starts at any of them: here the stretches
of a block are decoded side by side. Every part of a block and the directory
carry a crc32, which is verified before anything is decoded.

Ids are written in ascending ``doc_id`` order, rows without an id last, equal ids
by a hash of their text. Each document ends with the end id; where documents
begin is told by the index, since that id may occur in texts.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortline.llm.common import settle, table
from cohortline.llm.token_counts import Splitter
from cohortline.plans.durable import freeze, new_path
from cohortline.sources.files import get_file, put_file

VOCABULARY = "byte_bpe_50k.json"
END = 2
LANES = 1024
STRIDE = 1 << 18
BLOCK = 1 << 20
# Probabilities are multiples of 2**-20; states are kept in [2**31, 2**63).
_BITS, _LOW = 20, 31
_WORD = 32
MAGIC = b"ids-rans-1\n"
_TAIL = "<QI"
# Characters that are cut into words at a time, and bytes of words kept with their ids.
_SLICE, _KEPT_BYTES = 1 << 21, 160 << 20
_WORD_BYTES = 220
# Rows that are put to words at a time.
_ROWS = 1024
# White space after a letter or digit begins a word, whatever comes before it.
_CUT = re.compile(r"(?<=[0-9A-Za-z])[ \n]")
_NO_IDS = np.empty(0, np.uint32)


# Tokens of texts


class Tokens:
    """Ids of texts as the tokenizers library gives them.

    The vocabulary never joins two words of its pattern, so the library encodes
    each distinct word once and texts are put together from words. The words of a
    slice of text are grouped by a rolling hash, and every word is compared with
    the first of its group. Beyond ``_KEPT_BYTES`` kept words are thinned to those
    that came more than once.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        self.library, self.splitter = Tokenizer.from_file(path), Splitter()
        spec = json.loads(self.library.to_str())
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in spec["added_tokens"])
        plain = plain and all(map(str.isascii, added))
        pre = spec.get("pre_tokenizer") or {}
        known = spec["model"].get("vocab")
        # Anything but a plain byte-level vocabulary goes to the library as whole texts.
        self.by_words = (
            plain and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
            and pre.get("use_regex", True) and spec["model"]["type"] == "BPE" and not spec.get("normalizer")
            and not spec["model"].get("ignore_merges") and all(chr(c) in known for c in _spelling().tolist())
        )
        if self.by_words:
            # Words come cut and spelled already; a character of a token's spelling is a byte of the text.
            self.library.pre_tokenizer = None
            self.spans = np.zeros(1 + max(known.values(), default=0), np.int64)
            self.spans[list(known.values())] = list(map(len, known))
        self.added = added
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.begin = {t[0] for t in added}
        self._start([], np.empty(0, np.int64), _NO_IDS)

    def _start(self, words: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        self.place = dict(zip(words, range(len(words))))
        room = max(1024, 2 * len(words))
        self.ids, self.used = np.concatenate([ids, np.empty(4 * room, np.uint32)]), len(ids)
        self.size, self.hits = np.zeros(room, np.int64), np.zeros(room, np.int64)
        self.size[: len(words)] = sizes
        self.at = np.zeros(room, np.int64)
        self.at[: len(words)] = np.cumsum(sizes) - sizes
        self.bytes = sum(map(len, words)) + 4 * len(ids) + _WORD_BYTES * len(words)

    def _thin(self) -> None:
        """Keep words met again since the last time, the most frequent first, in half of the room."""
        words = np.array(list(self.place), object)
        hits = self.hits[: len(words)]
        order = np.argsort(-hits, kind="stable")
        cost = np.cumsum([_WORD_BYTES + len(w) for w in words[order]] + 4 * self.size[order])
        kept = np.sort(order[(hits[order] > 1) & (cost <= _KEPT_BYTES // 2)])
        self._start(words[kept].tolist(), self.size[kept], self.ids[_spread(self.at[kept], self.size[kept])])

    def _learn(self, words: list[str]) -> None:
        # One call for all of them, without offsets; the bytes that ids stand for tell where words end.
        spelled = _spelling()[np.frombuffer("".join(words).encode(), np.uint8)].tobytes().decode("utf-32-le")
        upto = np.cumsum([len(w) if w.isascii() else len(w.encode()) for w in words])
        cut = upto.tolist()
        parts = [spelled[a:b] for a, b in zip([0, *cut], cut)]
        ids = np.array(self.library.encode_batch_fast([parts], is_pretokenized=True, add_special_tokens=False)[0].ids, np.uint32)
        ends = np.searchsorted(np.cumsum(self.spans[ids]), upto) + 1
        sizes = np.diff(ends, prepend=0)
        known, more = len(self.place), len(words)
        while known + more > len(self.size):
            self.size, self.at, self.hits = (np.append(x, np.zeros_like(x)) for x in (self.size, self.at, self.hits))
        if self.used + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.empty(len(self.ids) + len(ids), np.uint32))
        self.ids[self.used : self.used + len(ids)] = ids
        self.at[known : known + more] = self.used + np.cumsum(sizes) - sizes
        self.size[known : known + more] = sizes
        self.place.update(zip(words, range(known, known + more)))
        self.used += len(ids)
        self.bytes += sum(map(len, words)) + 4 * len(ids) + _WORD_BYTES * more

    def _segments(self, text: str) -> Iterator[str | int]:
        """Plain stretches of bounded length and the ids of special strings, in order."""
        at = 0
        for found in self.special.finditer(text) if any(map(text.__contains__, self.begin)) else ():
            yield text[at : found.start()]
            yield self.added[found.group()]
            at = found.end()
        part = text[at:] if at else text
        while len(part) > _SLICE and (cut := _CUT.search(part, _SLICE)):
            yield part[: cut.start()]
            part = part[cut.start() :]
        yield part

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if not self.by_words:
            return [np.array(e.ids, np.uint32) for e in self.library.encode_batch(texts, add_special_tokens=False)]
        found: list[list[np.ndarray]] = [[] for _ in texts]
        held: list[tuple[list, int, str]] = []
        size = 0
        for own, text in zip(found, texts):
            for part in self._segments(text):
                if isinstance(part, int):
                    own.append(np.array([part], np.uint32))
                elif part:
                    # The place is taken now and filled with its slice.
                    own.append(_NO_IDS)
                    held.append((own, len(own) - 1, part))
                    size += len(part)
            if size >= _SLICE:
                self._fill(held)
                held, size = [], 0
        self._fill(held)
        return [own[0] if len(own) == 1 else np.concatenate([*own, _NO_IDS]) for own in found]

    def _fill(self, held: list[tuple[list, int, str]]) -> None:
        """Encode stretches of text by their words, each into its place."""
        if not held:
            return
        joined = "".join(part for *_, part in held)
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.cumsum([0, *(len(part) for *_, part in held[:-1])])
        begins = self.splitter.marks(chars, starts)
        edges = np.append(begins, len(chars))
        first, same = _distinct(chars, begins, np.diff(edges))
        ends = edges[first + 1]
        words = [joined[a:b] for a, b in zip(begins[first].tolist(), ends.tolist())]
        if self.bytes > _KEPT_BYTES:
            self._thin()
        at = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(at < 0).tolist()
        if new:
            missing = list(dict.fromkeys([words[i] for i in new]))
            self._learn(missing)
            at[new] = [self.place[words[i]] for i in new]
        np.add.at(self.hits, at, np.bincount(same, minlength=len(at)))
        sizes = self.size[at][same]
        ids = self.ids[_spread(self.at[at][same], sizes)]
        upto = np.append(0, np.cumsum(sizes))[np.searchsorted(begins, np.append(starts, len(chars)))]
        for (own, i, _), a, b in zip(held, upto.tolist(), upto[1:].tolist()):
            own[i] = ids[a:b]


@cache
def _spelling() -> np.ndarray:
    """The character by which byte-level vocabularies spell each byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars = np.arange(256, dtype="<u4")
    hidden = np.setdiff1d(np.arange(256), shown)
    chars[hidden] = 0x100 + np.arange(len(hidden))
    return chars


def _spread(at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places ``at, at + 1, ...`` of each stretch, one after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(at - (np.cumsum(sizes) - sizes), sizes)


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and their inverses."""
    base = 0x9E3779B97F4A7C15
    up, down = np.full(1 << bits, base, np.uint64), np.full(1 << bits, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _distinct(chars: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words stand first among their equals, and for every word the number of its first one."""
    # Tables are kept for slices of the usual size only.
    bits = max(len(chars).bit_length(), 22)
    up, down = _powers(bits) if bits == 22 else _powers.__wrapped__(bits)
    code = (chars.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    sums = np.append(np.uint64(0), np.cumsum((code ^ (code >> np.uint64(29))) * up[: len(chars)]))
    hashes = (sums[begins + sizes] - sums[begins]) * down[begins] + sizes.astype(np.uint64)
    hashes ^= hashes >> np.uint64(32)
    # Most of the hash and the place in one number, which sorts faster than by an index.
    places = np.uint64((1 << len(begins).bit_length()) - 1)
    order = np.sort((hashes & ~places) | np.arange(len(begins), dtype=np.uint64))
    new = np.append(True, (order[1:] ^ order[:-1]) > places)[: len(order)]
    order = (order & places).astype(np.int64)
    first, same = order[new], np.empty(len(order), np.int64)
    same[order] = np.cumsum(new) - 1
    there = _spread(begins[first][same], sizes)
    if not ((sizes[first][same] == sizes).all() and (chars[there] == chars).all()):
        # Two words under one hash: every word stands for itself.
        first = same = np.arange(len(begins))
    return first, same


@cache
def _tokens(path: str) -> Tokens:
    """One encoder for each vocabulary in a Python worker."""
    return Tokens(path)


def vocabulary_path(path: str | None) -> str:
    import public_tokenizers

    return path or public_tokenizers.path(VOCABULARY)


# The coder


class Table:
    """Frequencies of ids that add up to ``2**_BITS``; every id that occurs has at least one."""

    def __init__(self, ids: np.ndarray, shares: np.ndarray) -> None:
        self.ids, self.shares = ids.astype(np.uint32), shares.astype(np.uint64)
        if len(ids) and int(self.shares.sum()) != 1 << _BITS:
            raise ValueError("the frequency table does not add up")
        self.below = np.cumsum(self.shares) - self.shares
        self.slot = np.repeat(np.arange(len(ids), dtype=np.uint32), self.shares.astype(np.int64))
        self.place = np.full(int(self.ids.max()) + 1 if len(ids) else 0, -1, np.int64)
        self.place[self.ids] = np.arange(len(ids))

    @classmethod
    def of_counts(cls, counts: dict[int, int]) -> Table:
        """Shares by the largest counts; what is left by rounding goes to the most frequent ids."""
        if len(counts) > 1 << (_BITS - 1):
            raise ValueError(f"{len(counts)} different ids; at most {1 << (_BITS - 1)} can be coded")
        if not counts:
            return cls(np.empty(0, np.uint32), np.empty(0, np.uint64))
        ids = sorted(counts)
        total, free = sum(counts.values()), (1 << _BITS) - len(ids)
        shares = np.array([1 + counts[i] * free // total for i in ids], np.int64)
        order = np.lexsort((ids, [-counts[i] for i in ids]))
        left = (1 << _BITS) - int(shares.sum())
        shares[order[:left]] += 1
        return cls(np.array(ids), shares)

    def pack(self) -> bytes:
        body = self.ids.astype("<u4").tobytes() + self.shares.astype("<u4").tobytes()
        return MAGIC + struct.pack("<II", len(self.ids), zlib.crc32(body)) + body

    @classmethod
    def unpack(cls, data: bytes) -> Table:
        n, crc = struct.unpack_from("<II", data, len(MAGIC))
        body = data[len(MAGIC) + 8 :]
        if not data.startswith(MAGIC) or len(body) != 8 * n or zlib.crc32(body) != crc:
            raise ValueError("the frequency table is damaged")
        return cls(np.frombuffer(body, "<u4", n), np.frombuffer(body, "<u4", n, 4 * n))


def encode_block(ids: np.ndarray, shared: Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of the stream, states at each checkpoint, and words read before each checkpoint."""
    at = shared.place[ids] if len(ids) == 0 or int(ids.max()) < len(shared.place) else np.array([-1])
    if len(at) and int(at.min()) < 0:
        raise ValueError("an id is not in the frequency table")
    share, below = shared.shares[at], shared.below[at]
    limit = share << np.uint64(_LOW + _WORD - _BITS)
    state = np.full(LANES, 1 << _LOW, np.uint64)
    steps, per = -(-len(ids) // LANES), STRIDE // LANES
    words, written = [], 0
    states, behind = [], []
    bits, word, low = np.uint64(_BITS), np.uint64(_WORD), np.uint64((1 << _WORD) - 1)
    for step in range(steps - 1, -1, -1):
        own = slice(step * LANES, min((step + 1) * LANES, len(ids)))
        x = state[: own.stop - own.start]
        full = np.flatnonzero(x >= limit[own])
        if len(full):
            out = x[full]
            words.append((out & low).astype(np.uint32))
            written += len(full)
            x[full] = out >> word
        whole, rest = np.divmod(x, share[own])
        x[:] = (whole << bits) + rest + below[own]
        if step % per == 0:
            states.append(state.copy())
            behind.append(written)
    stream = np.concatenate(words[::-1]) if words else np.empty(0, np.uint32)
    before = written - np.array(behind[::-1], np.int64)
    return stream, np.array(states[::-1], np.uint64).reshape(-1, LANES), before


def decode_block(n: int, stream: np.ndarray, states: np.ndarray, before: np.ndarray, shared: Table) -> np.ndarray:
    """The ids of a block; all stretches between checkpoints are decoded side by side."""
    parts = len(states)
    if not parts:
        return np.empty(0, np.uint32)
    out = np.zeros((parts, STRIDE // LANES, LANES), np.uint32)
    state, at = states.astype(np.uint64), before.astype(np.int64)
    stream = np.append(stream, np.zeros(1, np.uint32)).astype(np.uint64)
    mask, bits, word = np.uint64((1 << _BITS) - 1), np.uint64(_BITS), np.uint64(_WORD)
    last = n - (parts - 1) * STRIDE
    for step in range(min(STRIDE, n) // LANES + (1 if min(STRIDE, n) % LANES else 0)):
        # The last stretch may end early, within a step or before it.
        live = parts if step * LANES < last else parts - 1
        if not live:
            break
        x = state[:live]
        low = x & mask
        symbol = shared.slot[low]
        moved = shared.shares[symbol] * (x >> bits) + low - shared.below[symbol]
        short = moved < np.uint64(1 << _LOW)
        idle = None
        if live == parts and last - step * LANES < LANES:
            idle = last - step * LANES
            short[-1, idle:] = False
        counts = short.sum(1)
        place = np.repeat(at[:live] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        moved[short] = (moved[short] << word) | stream[place]
        at[:live] += counts
        if idle is not None:
            moved[-1, idle:] = x[-1, idle:]
        state[:live] = moved
        out[:live, step] = symbol
    return shared.ids[out.reshape(-1)[:n]]


# Files


@dataclass
class Pieces:
    """The documents of a block: ``count`` ids of each lie in it."""

    first: int  # number of the first one in its part
    doc: np.ndarray
    known: np.ndarray  # whether the document has an id
    count: np.ndarray
    opens: bool  # the first one begins here
    closes: bool  # the last one ends here

    def pack(self) -> bytes:
        heads = struct.pack("<qI??", self.first, len(self.doc), self.opens, self.closes)
        body = self.doc.astype("<i8").tobytes() + self.count.astype("<i8").tobytes() + self.known.astype("u1").tobytes()
        return zlib.compress(heads + body, 6)

    @classmethod
    def unpack(cls, data: bytes) -> Pieces:
        body = zlib.decompress(data)
        first, n, opens, closes = struct.unpack_from("<qI??", body)
        at = struct.calcsize("<qI??")
        return cls(
            first,
            np.frombuffer(body, "<i8", n, at),
            np.frombuffer(body, "u1", n, at + 16 * n).astype(bool),
            np.frombuffer(body, "<i8", n, at + 8 * n),
            opens,
            closes,
        )


def _blocks(ids: list[np.ndarray], docs: list[tuple[int, int | None]], final: bool, block: int, opened: bool) -> tuple:
    """Cut held ids into blocks; gives ``(ids, pieces)`` of each and what stays behind."""
    out = []
    while docs and (sum(map(len, ids)) >= block or final):
        taken, named, room = [], [], block
        opens, closes = not opened, True
        while docs and room:
            part = ids[0][:room]
            taken.append(part)
            named.append((*docs[0], len(part)))
            room -= len(part)
            if len(part) < len(ids[0]):
                ids[0], closes, opened = ids[0][len(part) :], False, True
                break
            del ids[0], docs[0]
            opened = False
        pieces = Pieces(
            named[0][0],
            np.array([0 if d is None else d for _, d, _ in named], np.int64),
            np.array([d is not None for _, d, _ in named]),
            np.array([n for _, _, n in named], np.int64),
            opens,
            closes,
        )
        out.append((np.concatenate(taken), pieces))
    return out, opened


_STREAM = "part int, block long, first long, n long, wide boolean, ids binary, pieces binary"


def token_stream(docs: DataFrame, path: str | None = None, end: int = END, block: int = BLOCK) -> DataFrame:
    """Blocks of the ids of all texts in order: ``part, block, first, n, wide, ids, pieces``.

    Parts are ranges of ``doc_id``; a block is at most ``block`` ids, in two bytes
    each where they fit, and ``first`` is its place in the part.
    """
    where = vocabulary_path(path)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    ).withColumn("copy", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    # Equal rows differ in ``row``, so that copies under one id are spread too.
    order = [F.col("doc").asc_nulls_last(), F.col("copy"), F.col("row")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc", "text")

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = _tokens(where), TaskContext.get().partitionId()
        ids: list[np.ndarray] = []
        named: list[tuple[int, int | None]] = []
        opened, number, first, seen, held = False, 0, 0, 0, 0

        def flush(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal opened, number, first, held
            made, opened = _blocks(ids, named, final, block, opened)
            for tokens, pieces in made:
                wide = bool(len(tokens)) and int(tokens.max()) >= 1 << 16
                packed = tokens.astype("<u4" if wide else "<u2").tobytes()
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([part], pa.int32()), "block": [number], "first": [first],
                        "n": [len(tokens)], "wide": [wide], "ids": pa.array([packed], pa.binary()),
                        "pieces": pa.array([pieces.pack()], pa.binary()),
                    }
                )
                number, first = number + 1, first + len(tokens)
            held = sum(map(len, ids))

        stop = np.array([end], np.uint32)
        for batch in parts:
            doc = batch["doc"].to_pylist()
            for at in range(0, batch.num_rows, _ROWS):
                texts = [t.as_py().decode("utf-8", "replace") for t in batch["text"][at : at + _ROWS]]
                for tokens, d in zip(own.encode(texts), doc[at : at + _ROWS]):
                    ids.append(np.concatenate([tokens, stop]))
                    named.append((seen, d))
                    seen += 1
                    held += len(tokens) + 1
                if held >= block:
                    yield from flush(False)
        yield from flush(True)

    return ranged.mapInArrow(cut, _STREAM)


def _unpacked(packed: bytes, wide: bool) -> np.ndarray:
    return np.frombuffer(packed, "<u4" if wide else "<u2").astype(np.uint32)


def id_counts(stream: DataFrame) -> DataFrame:
    """``id, n`` over all blocks; every task sends one row for each id it met."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for part in parts:
            for packed, wide in zip(part["ids"], part["wide"].to_pylist()):
                found = np.bincount(_unpacked(packed.as_buffer(), wide)) if packed.as_buffer().size else np.zeros(1, np.int64)
                if len(found) > len(total):
                    found, total = total, found
                total[: len(found)] += found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(seen, pa.int64()), "n": pa.array(total[seen], pa.int64())})

    return stream.select("ids", "wide").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(
    docs: DataFrame, folder: str, path: str | None = None, end: int = END, block: int = BLOCK
) -> DataFrame:
    """Encode every text and write the data set; returns one row for each file.

    ``docs`` needs ``doc_id``, a whole number, and ``text``; other columns are
    ignored. Null texts count as empty, so such a document is its end id alone;
    an empty table gives a folder with a table of no ids. Repeated rows are
    written as often as they occur. Encoded blocks are kept in a written table
    until the frequencies of all ids are known; the table of frequencies, which
    the vocabulary bounds, is all that passes through the driver.
    """
    spark = docs.sparkSession
    stream = settle(token_stream(docs, path, end, block))
    shared = Table.of_counts({r["id"]: r["n"] for r in id_counts(stream).collect()})
    put_file(f"{folder}/table", [shared.pack()])
    sent = spark.sparkContext.broadcast(shared.pack())

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Table.unpack(sent.value)
        crc = zlib.crc32(sent.value)
        held: list[tuple[dict, list[bytes]]] = []

        def close() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            first = held[0][0]
            name = f"{folder}/ids-{first['part']:07d}-{first['block']:09d}"
            tail = json.dumps({"table": crc, "blocks": [d for d, _ in held]}).encode()
            put_file(name, [*(x for _, b in held for x in b), tail, struct.pack(_TAIL, len(tail), zlib.crc32(tail)), MAGIC])
            yield pa.RecordBatch.from_pydict({"file": [name], "blocks": [len(held)], "ids": [sum(d["n"] for d, _ in held)]})
            held.clear()

        at = 0
        for batch in parts:
            for row in batch.to_pylist():
                follows = held and (held[-1][0]["part"], held[-1][0]["block"] + 1) == (row["part"], row["block"])
                if not follows:
                    yield from close()
                    at = 0
                stream, states, before = encode_block(_unpacked(row["ids"], row["wide"]), own)
                body = [stream.astype("<u4").tobytes(), states.astype("<u8").tobytes(), before.astype("<i8").tobytes(), row["pieces"]]
                entry = {
                    "part": row["part"], "block": row["block"], "first": row["first"], "n": row["n"], "at": at,
                    "sizes": [len(b) for b in body], "crc": [zlib.crc32(b) for b in body],
                }
                at += sum(map(len, body))
                held.append((entry, body))
        yield from close()

    return freeze(stream.mapInArrow(write, "file string, blocks long, ids long"))


_DIRECTORY = "file string, entry string, part int, block long, n long"


def directory(spark: SparkSession, folder: str) -> DataFrame:
    """``file, entry, part, block, n`` of every block, from the ends of the files."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "ids-*").load(folder)
        .select("path", "length").repartition("path")
    )

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for file, length in zip(part["path"].to_pylist(), part["length"].to_pylist()):
                fixed = struct.calcsize(_TAIL) + len(MAGIC)
                end = get_file(file, length - fixed, fixed) if length >= fixed else b""
                if not end.endswith(MAGIC):
                    raise ValueError(f"not a file of ids: {file}")
                size, crc = struct.unpack_from(_TAIL, end)
                tail = get_file(file, length - fixed - size, size)
                if zlib.crc32(tail) != crc:
                    raise ValueError(f"the directory is damaged: {file}")
                blocks = json.loads(tail)["blocks"]
                yield pa.RecordBatch.from_pydict(
                    {
                        "file": [file] * len(blocks), "entry": [json.dumps(b) for b in blocks],
                        "part": pa.array([b["part"] for b in blocks], pa.int32()),
                        "block": [b["block"] for b in blocks], "n": [b["n"] for b in blocks],
                    }
                )

    return files.mapInArrow(read, _DIRECTORY)


def read_block(file: str, entry: dict, shared: Table) -> tuple[np.ndarray, Pieces]:
    """Ids and documents of one block; damaged bytes raise an error."""
    data = memoryview(get_file(file, entry["at"], sum(entry["sizes"])))
    body, at = [], 0
    for size, crc in zip(entry["sizes"], entry["crc"]):
        body.append(data[at : at + size])
        if zlib.crc32(body[-1]) != crc:
            raise ValueError(f"block {entry['block']} is damaged: {file}")
        at += size
    stream, states, before = (np.frombuffer(b, t) for b, t in zip(body, ("<u4", "<u8", "<i8")))
    ids = decode_block(entry["n"], stream, states.reshape(-1, LANES), before, shared)
    return ids, Pieces.unpack(body[3])


def _read(spark: SparkSession, folder: str, values: Callable, kind: str) -> DataFrame:
    """``part, doc, doc_id, opens, closes, start, n`` of every piece, and a value of its ids."""
    blocks = settle(directory(spark, folder))
    # One row for each part of the key range, whose number Spark's settings bound.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        blocks.groupBy("part").agg(F.sum("n").alias("ids"))
        .select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    )
    sent = spark.sparkContext.broadcast(get_file(f"{folder}/table"))

    def decode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = Table.unpack(sent.value)
        for part in parts:
            for file, text in zip(part["file"].to_pylist(), part["entry"].to_pylist()):
                entry = json.loads(text)
                ids, pieces = read_block(file, entry, shared)
                n = len(pieces.count)
                ends = np.cumsum(pieces.count)
                opens, closes = np.ones(n, bool), np.ones(n, bool)
                opens[0], closes[-1] = pieces.opens, pieces.closes
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, entry["part"], np.int32)),
                        pa.array(pieces.first + np.arange(n)),
                        pa.array(pieces.doc, mask=~pieces.known),
                        pa.array(opens),
                        pa.array(closes),
                        pa.array(entry["first"] + ends - pieces.count),
                        pa.array(pieces.count),
                        values(ids, ends),
                    ],
                    ["part", "doc", "doc_id", "opens", "closes", "at", "n", "value"],
                )

    schema = f"part int, doc long, doc_id long, opens boolean, closes boolean, at long, n long, value {kind}"
    # A block is a million ids, so one is enough for a task, and a few do not cost much.
    count = blocks.count()
    tasks = max(min(count, 4 * spark.sparkContext.defaultParallelism), -(-count // 64), 1)
    found = blocks.repartition(tasks, "file", "block").mapInArrow(decode, schema)
    return found.join(F.broadcast(base), "part").withColumn("start", F.col("base") + F.col("at")).drop("base", "at")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of a data set: ``part, doc, doc_id, opens, closes, start, n, ids``.

    A row is a document, or a piece of one that crosses blocks: ``part`` and
    ``doc`` name it, ``start`` is the number of ids before it in the data set.
    """

    def values(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids.astype(np.int64)))

    return _read(spark, folder, values, "array<long>").withColumnRenamed("value", "ids")


# Checksums


@cache
def _shift(bit: int) -> tuple[int, ...]:
    """What ``2**bit`` zero bytes do to each bit of a crc32."""
    if not bit:
        return tuple(_apply_zero_byte(1 << i) for i in range(32))
    half = _shift(bit - 1)
    return tuple(_times(half, half[i]) for i in range(32))


def _apply_zero_byte(crc: int) -> int:
    for _ in range(8):
        crc = crc >> 1 ^ (0xEDB88320 if crc & 1 else 0)
    return crc


def _times(matrix: tuple[int, ...], value: int) -> int:
    out = 0
    for i in range(32):
        if value >> i & 1:
            out ^= matrix[i]
    return out


def joined_crc(first: int, second: int, size: int) -> int:
    """crc32 of two strings in a row, from theirs and the length of the second."""
    bit = 0
    while size:
        if size & 1:
            first = _times(_shift(bit), first)
        size >>= 1
        bit += 1
    return first ^ second


def _joined(pieces: Column) -> Column:
    """crc32 of the pieces of a document in order."""

    @F.arrow_udf("long")
    def join(lists: pa.Array) -> pa.Array:
        out = []
        for pieces in lists:
            crc = 0
            for p in pieces.as_py():
                crc = joined_crc(crc, p["value"], 4 * p["n"])
            out.append(crc)
        return pa.array(out, pa.int64())

    return join(pieces)


def read_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document of a data set.

    ``ids_crc32`` is that of the ids as little-endian 32-bit numbers. Documents
    within a block are done where it is decoded; the pieces of the others, at most
    two for each block, are put together from their checksums.
    """

    def values(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        data, at = memoryview(ids.astype("<u4").tobytes()), [0, *(4 * ends).tolist()]
        return pa.array([zlib.crc32(data[a:b]) for a, b in zip(at, at[1:])], pa.int64())

    found = settle(_read(spark, folder, values, "long"))
    whole = F.col("opens") & F.col("closes")
    cut = (
        found.filter(~whole).groupBy("part", "doc")
        .agg(
            F.min("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("n").alias("n_tokens"),
            F.array_sort(F.collect_list(F.struct("start", "n", "value"))).alias("pieces"),
        )
        .select("doc_id", "start", "n_tokens", _joined(F.col("pieces")).alias("ids_crc32"))
    )
    columns = ["doc_id", "start", F.col("n").alias("n_tokens"), F.col("value").alias("ids_crc32")]
    return found.filter(whole).select(*columns).unionByName(cut)


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum, from the files that were written."""
    folder = new_path(spark, "ids")
    write_token_files(table(spark, sf_dir, "documents").select("doc_id", "text"), folder)
    return read_checksums(spark, folder)
