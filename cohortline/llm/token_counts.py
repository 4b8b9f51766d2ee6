"""Token counts of a byte-level BPE vocabulary by two compiled transducers.

The splitter reads one class per character and marks where a word of the
vocabulary's pattern begins. It has eight states, so the state map of any piece
of text is one element of a small monoid: chunks of a slice are reduced to their
elements side by side, the elements are composed by a parallel prefix scan, and
a second pass emits the marks of all chunks from their known entry states.

The merger reads the bytes of a word. Its state is what the encoding of the
bytes so far can still contribute to longer tokens, and each transition carries
the change of the number of tokens, which may be negative. An encoding is the
only token sequence whose neighbours all stay apart when merged as a pair, so
the last token of each prefix follows from earlier ones. States are compiled
when first met and shared by all words; all words advance side by side.
"""

from __future__ import annotations

import json
import re
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm.common import table

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
# Characters that are worked on at a time, and compiled states that are kept.
SLICE = 1 << 21
STATES = 1 << 18
_CHUNK = 256

# Character classes and the symbols of the splitter.
_LETTER, _NUMBER, _OTHER, _SPACE, _WHITE = range(5)
_L, _N, _P, _A1, _A2, _SPACE_LAST, _WHITE_LAST, _WHITE_MORE = range(8)
_FRESH, _IN_L, _IN_N, _IN_P, _IN_SPACE, _IN_WHITE, _C1, _C2 = range(8)
_START = 8  # added to the symbol at the start of a segment


def _move(state: int, symbol: int) -> tuple[int, bool]:
    """Next state of the splitter and whether a word begins at the symbol."""
    if symbol >= _START:
        return _move(_FRESH, symbol - _START)[0], True
    if symbol == _L:
        if state == _C2:
            return _C1, False
        if state == _C1:
            return _FRESH, False
        return _IN_L, state not in (_IN_L, _IN_SPACE)
    if symbol == _N:
        return _IN_N, state not in (_IN_N, _IN_SPACE)
    if symbol in (_P, _A1, _A2):
        if state in (_IN_P, _IN_SPACE):
            return _IN_P, False
        return {_P: _IN_P, _A1: _C1, _A2: _C2}[symbol], True
    if symbol == _SPACE_LAST:
        return _IN_SPACE, True
    if symbol == _WHITE_LAST:
        return _FRESH, True
    return _IN_WHITE, state != _IN_WHITE


class Splitter:
    """Marks word beginnings in a stream of segments."""

    def __init__(self) -> None:
        symbols = range(2 * _START)
        self.next = np.array([[_move(s, a)[0] for a in symbols] for s in range(8)], np.uint8)
        self.begins = np.array([[_move(s, a)[1] for a in symbols] for s in range(8)])
        maps = {tuple(range(8)): 0}
        queue, act = [tuple(range(8))], []
        for m in queue:
            row = []
            for a in symbols:
                to = tuple(int(self.next[s, a]) for s in m)
                if to not in maps:
                    maps[to] = len(maps)
                    queue.append(to)
                row.append(maps[to])
            act.append(row)
        self.act = np.array(act, np.int32)
        self.maps = np.array(queue, np.uint8)
        self.compose = np.array(
            [[maps[tuple(b[s] for s in a)] for b in queue] for a in queue], np.int32
        )
        self.classes = _character_classes()

    def symbols(self, chars: np.ndarray, starts: np.ndarray) -> np.ndarray:
        kind = self.classes[chars]
        # What follows: white space or the end of the segment, or something else.
        ends = np.zeros(len(chars), bool)
        ends[starts[1:] - 1] = True
        ends[-1] = True
        white = kind >= _SPACE
        more = np.empty(len(chars), bool)
        more[:-1] = white[1:]
        more |= ends
        symbol = kind.copy()
        symbol[kind == _SPACE] = _SPACE_LAST
        symbol[kind == _WHITE] = _WHITE_LAST
        symbol[white & more] = _WHITE_MORE
        marks = np.flatnonzero((chars == ord("'")) & ~ends)
        if len(marks):
            after = chars[marks + 1]
            symbol[marks[np.isin(after, [ord(c) for c in "stmd"])]] = _A1
            two = marks[~ends[marks + 1]]
            pair = chars[two + 1].astype(np.uint64) << np.uint64(32) | chars[two + 2]
            known = [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")]
            symbol[two[np.isin(pair, np.array(known, np.uint64))]] = _A2
        symbol[starts] += _START
        return symbol

    def marks(self, chars: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Positions of word beginnings; ``starts`` are the segment beginnings, 0 first."""
        size = len(chars)
        rows = -(-size // _CHUNK)
        symbol = np.full(rows * _CHUNK, _L, np.uint8)
        symbol[:size] = self.symbols(chars, starts)
        lanes = np.ascontiguousarray(symbol.reshape(rows, _CHUNK).T)
        act, width = self.act.ravel(), 2 * _START
        element = np.zeros(rows, np.int32)
        for column in lanes:
            element = act[element * width + column]
        # Inclusive prefix scan of the chunks' elements.
        gap = 1
        while gap < rows:
            later = self.compose[element[:-gap], element[gap:]]
            element = np.concatenate([element[:gap], later])
            gap *= 2
        state = np.zeros(rows, np.int32)
        state[1:] = self.maps[element[:-1], _FRESH]
        following, begins = self.next.ravel().astype(np.int32), self.begins.ravel()
        found = np.empty(lanes.shape, bool)
        for i, column in enumerate(lanes):
            at = state * width + column
            found[i] = begins[at]
            state = following[at]
        return np.flatnonzero(found.T.ravel()[:size])


def _character_classes() -> np.ndarray:
    import regex

    kinds = np.full(0x110000, _OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", _LETTER), (r"\p{N}", _NUMBER), (r"\p{White_Space}", _WHITE)):
        one = regex.compile(pattern)
        for start in range(0, 0x110000, 0x8000):
            if 0xD800 <= start < 0xE000:
                continue
            block = "".join(map(chr, range(start, start + 0x8000)) if start != 0xD000 else ())
            for m in one.finditer(block):
                kinds[start + m.start()] = kind
    kinds[0x20] = _SPACE
    return kinds


class Transitions:
    """Transitions by ``state * 256 + byte`` in an open hash table that numpy can probe."""

    def __init__(self) -> None:
        self._resize(16)
        self.used = 0

    def _resize(self, bits: int) -> None:
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.to = np.zeros(1 << bits, np.int32)
        self.delta = np.zeros(1 << bits, np.int16)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key: its own, or the empty one where it belongs."""
        at = self._home(keys)
        held = self.keys[at]
        lost = np.flatnonzero((held != keys) & (held >= 0))
        while len(lost):
            at[lost] = (at[lost] + 1) & self.mask
            held = self.keys[at[lost]]
            lost = lost[(held != keys[lost]) & (held >= 0)]
        return at

    def slot(self, key: int) -> int:
        at = (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> int(self.shift)
        while (held := self.keys[at]) != key and held >= 0:
            at = (at + 1) & self.mask
        return at

    def put(self, key: int, to: int, delta: int) -> None:
        if 4 * self.used > self.mask:
            full = np.flatnonzero(self.keys >= 0)
            old = self.keys[full].tolist(), self.to[full].tolist(), self.delta[full].tolist()
            self._resize(65 - int(self.shift))
            for k, t, d in zip(*old, strict=True):
                at = self.slot(k)
                self.keys[at], self.to[at], self.delta[at] = k, t, d
        at = self.slot(key)
        self.keys[at], self.to[at], self.delta[at] = key, to, delta
        self.used += 1


class Merger:
    """The transducer over the bytes of a word; states are compiled on demand."""

    def __init__(self, tokens: list[bytes], ranks: dict[tuple[bytes, bytes], int], states: int = STATES) -> None:
        self.tokens = set(tokens)
        self.prefixes = {t[:k] for t in tokens for k in range(1, len(t) + 1)}
        self.ranks, self.limit = ranks, states
        self.apart: dict[tuple[bytes, bytes], bool] = {}
        self.reset()

    def reset(self) -> None:
        # State 0 is the empty word; -1 marks words that are counted one by one.
        self.ids = {(b"", ((0, b"", 0),)): 0}
        self.states = [(b"", ((0, b"", 0),))]
        self.table = Transitions()

    def merge(self, word: bytes) -> list[bytes]:
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            ranked = [(self.ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:], strict=False))]
            rank, i = min(ranked)
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def stays_apart(self, left: bytes, right: bytes) -> bool:
        key = (left, right)
        known = self.apart.get(key)
        if known is None:
            known = self.merge(left + right) == [p for p in key if p]
            if len(self.apart) > STATES:
                self.apart.clear()
            self.apart[key] = known
        return known

    def step(self, state: tuple, byte: int) -> tuple[tuple, int]:
        """The state after a byte, and the change of the token count.

        A state is the longest end of the word that begins some token, and for
        each of its ends that do, the token before it and the count up to it.
        """
        tail, past = state
        before = {depth: (last, count) for depth, last, count in past}
        text = tail + bytes([byte])
        for length in range(len(text), 0, -1):
            token = text[len(text) - length :]
            if token in self.tokens and length - 1 in before:
                last, count = before[length - 1]
                if self.stays_apart(last, token):
                    break
        else:
            raise ValueError("the vocabulary does not cover every byte")
        count += 1
        ends = [d for d in range(len(text), 0, -1) if text[len(text) - d :] in self.prefixes]
        past = [(d, before[d - 1][0], before[d - 1][1] - count) for d in ends if d - 1 in before]
        tail = text[len(text) - past[0][0] :] if past else b""
        return (tail, (*past, (0, token, 0))), count

    def compile(self, state: int, byte: int) -> bool:
        """Fill in one transition; false when no further state may be kept."""
        to, change = self.step(self.states[state], byte)
        number = self.ids.get(to)
        if number is None:
            if len(self.states) >= 2 * self.limit:
                return False
            number = self.ids[to] = len(self.states)
            self.states.append(to)
        self.table.put(state * 256 + byte, number, change)
        return True

    def count_one(self, word: bytes) -> int:
        state, total = self.states[0], 0
        for byte in word:
            state, change = self.step(state, byte)
            total += change
        return total

    def counts(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tokens of each word ``data[start : start + size]``."""
        if len(self.states) > self.limit:
            self.reset()
        order = np.argsort(-sizes, kind="stable")
        places, longest = starts[order], int(sizes.max(initial=0))
        active = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(longest), side="right")
        state = np.zeros(len(sizes), np.int64)
        total = np.zeros(len(sizes), np.int64)
        single = []
        for step in range(longest):
            n = int(active[step])
            if n <= 16:
                # Few long words are left: one at a time is quicker.
                for i in range(n):
                    total[i] += self._finish(int(state[i]), data, int(places[i]) + step, int(places[i] + sizes[order[i]]))
                break
            key = state[:n] * 256 + data[places[:n] + step]
            at = self.table.find(key)
            missing = (self.table.keys[at] != key) & (key >= 0)
            if missing.any():
                for k in np.unique(key[missing]).tolist():
                    if not self.compile(k // 256, k % 256):
                        lost = np.flatnonzero(key == k)
                        single.extend(lost)
                        key[lost] = -1
                at = self.table.find(key)
            known = key >= 0
            total[:n] += np.where(known, self.table.delta[at], 0)
            state[:n] = np.where(known, self.table.to[at], -1)
        for i in single:
            begin = places[i]
            total[i] = self.count_one(data[begin : begin + sizes[order[i]]].tobytes())
        result = np.empty(len(sizes), np.int64)
        result[order] = total
        return result

    def _finish(self, state: int, data: np.ndarray, begin: int, end: int) -> int:
        if state < 0:
            return 0
        total = 0
        for at in range(begin, end):
            byte = int(data[at])
            slot = self.table.slot(state * 256 + byte)
            if self.table.keys[slot] < 0:
                if not self.compile(state, byte):
                    own = self.states[state]
                    for byte in data[at:end].tolist():
                        own, change = self.step(own, byte)
                        total += change
                    return total
                slot = self.table.slot(state * 256 + byte)
            total += int(self.table.delta[slot])
            state = int(self.table.to[slot])
        return total


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in plain):
        letters[chr(256 + n)] = b
    return letters


class Counter:
    """Counts the tokens of texts with one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letters = _byte_letters()
        spelled = cache(lambda word: bytes(letters[c] for c in word))
        added = [t["content"] for t in content["added_tokens"]]
        words = [w for w in content["model"]["vocab"] if w not in added]
        ranks = {(spelled(a), spelled(b)): i for i, (a, b) in enumerate(content["model"]["merges"])}
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True))) or "(?!)")
        self.splitter = Splitter()
        self.merger = Merger([spelled(w) for w in words], ranks)

    def _segments(self, texts: list[str]):
        """``(row, segment)`` pairs: between special strings, and long ones cut where a word surely begins."""
        for row, text in enumerate(texts):
            for part in self.special.split(text):
                while len(part) > SLICE:
                    cut = _CUT.search(part, SLICE)
                    if not cut:
                        break
                    yield row, part[: cut.start()]
                    part = part[cut.start() :]
                if part:
                    yield row, part

    def counts(self, texts: list[str]) -> np.ndarray:
        total = np.array([len(self.special.findall(t)) for t in texts], np.int64)
        held, size = [], 0
        for row, part in self._segments(texts):
            held.append((row, part))
            size += len(part)
            if size >= SLICE:
                self._add(total, held)
                held, size = [], 0
        if held:
            self._add(total, held)
        return total

    def _add(self, total: np.ndarray, held: list[tuple[int, str]]) -> None:
        joined = "".join(part for _, part in held)
        chars = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
        data = np.frombuffer(joined.encode("utf-8", "replace"), np.uint8)
        sizes = np.array([len(part) for _, part in held])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        begins = self.splitter.marks(chars, starts)
        width = 1 + (chars >= 0x80).astype(np.int64) + (chars >= 0x800) + (chars >= 0x10000)
        places = np.cumsum(width) - width
        at = places[begins]
        length = np.diff(np.append(at, len(data)))
        counts = self.merger.counts(data, at, length)
        rows = np.array([row for row, _ in held])[np.searchsorted(starts, begins, side="right") - 1]
        np.add.at(total, rows, counts)


# White space after something else begins a word, whatever comes before it.
_CUT = re.compile(r"(?<=[0-9A-Za-z])[ \n]")


@cache
def counter(path: str) -> Counter:
    """One counter for each vocabulary in a Python worker."""
    return Counter(path)


def tokens_of(text: Column, vocabulary: str = VOCABULARY, path: str | None = None) -> Column:
    """Number of tokens of a text column; null counts as empty."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        import public_tokenizers

        found = counter(path or public_tokenizers.path(vocabulary))
        return pd.Series(found.counts(texts.fillna("").tolist()))

    return count(text)


def token_counts(docs: DataFrame, limit: int = LIMIT, vocabulary: str = VOCABULARY, path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Null and
    empty texts have no bytes and no tokens. Special strings of the vocabulary
    are one token each. Repeated rows give repeated results.
    """
    counted = docs.select("doc_id", "text", tokens_of(F.col("text"), vocabulary, path).alias("n_tokens"))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
