"""SentencePiece encoding and decoding by a max-plus scan over chunks.

A text is a lattice: its edges are the pieces that match somewhere, and a path
from the start to the end is an encoding. Two neighbouring edges have a weight:
for a unigram model the score of the later piece, for a BPE model zero if the
two stay apart when merged as a pair and minus infinity if not. The only path
without a forbidden pair is the encoding that the merges give, since the first
merge across a border would also happen in the pair alone.

The state at a cut is the edge that covers the character before it. A long text
is cut into chunks; a chunk gives the max-plus matrix of the best weight from
each state at its left cut to each at its right cut. The matrices are combined
by an associative prefix scan, the states at the cuts are read off from the end,
and every chunk is backtraced on its own. Where no piece of the model can cross,
as before the blank of a word, a cut has one state and its sides are independent;
the path of such a short stretch is kept for the next time it is met.
"""

from __future__ import annotations

from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm.common import table

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
CHUNK = 64
# Bytes of the stretches whose encoding is kept, of the pairs whose verdict is kept, and of the steps
# that find the pieces that end at a character, in a worker; and what an entry costs besides its characters and ids.
KEPT_BYTES, PAIR_BYTES, STEP_BYTES = 96 << 20, 40 << 20, 24 << 20
_ENTRY = 190
# Where pieces may be cut: before the blank of a word, and between letters and
# anything else; each with what no piece of a model may hold for that.
_WORDS = regex.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+"), regex.compile(f"[^{BLANK}]{BLANK}")
_RUNS = (
    regex.compile(rf"{BLANK}*\p{{L}}+|{BLANK}*[^\p{{L}}{BLANK}]+|{BLANK}+"),
    regex.compile(rf"\p{{L}}\P{{L}}|[^\p{{L}}{BLANK}][\p{{L}}{BLANK}]"),
)
# The same for texts that hold no blank mark, before their blanks become one.
_PLAIN = {cut: regex.compile(cut.pattern.replace(BLANK, " ")) for cut, _ in (_WORDS, _RUNS)}
_NONE = -np.inf

Edge = tuple[int, int]
# Steps by the next character, pieces that end here with their lengths, the longest first, and the text so far.
Node = tuple[dict, tuple, str]


def max_plus(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Product of two transfer matrices: the best weight over the state between."""
    return (left[:, :, None] + right[None, :, :]).max(1)


def prefix_scan(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """Products of the first 1, 2, ... matrices in a logarithmic number of rounds."""
    done, gap = list(matrices), 1
    while gap < len(done):
        done = done[:gap] + [max_plus(a, b) for a, b in zip(done, done[gap:], strict=False)]
        gap *= 2
    return done


class Encoder:
    """Encodes and decodes with the pieces of one model.

    ``scores`` gives the ordinary pieces with ids and scores, ``byte_ids`` the
    ids of the 256 byte pieces that spell characters without a piece.
    """

    def __init__(self, scores: dict[str, tuple[int, float]], byte_ids: list[int], bpe: bool = True) -> None:
        self.scores, self.byte_ids, self.bpe = scores, byte_ids, bpe
        # The piece that a text is, if any, for the beginnings of all pieces.
        self.matches = {p[:k]: "" for p in scores for k in range(1, len(p) + 1)} | {p: p for p in scores}
        self.longest = max(map(len, scores), default=1)
        self.unknown = min((s for _, s in scores.values()), default=0.0) - 10
        fitting = [cut for cut, never in (_RUNS, _WORDS) if not any(map(never.search, scores))]
        self.stretches = fitting[0].findall if fitting else lambda text: [text]
        self.plain_stretches = _PLAIN[fitting[0]].findall if fitting else lambda text: [text]
        # Weights by the piece before and the piece.
        self.apart: dict[str, dict[str, float]] = {}
        self.pairs = 0
        self.nodes: dict[str, Node] = {"": ({}, (), "")}
        self.steps = 0
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.bytes = 0
        self.spelled = {i: p for p, (i, _) in scores.items()}
        self.byte_of = {i: b for b, i in enumerate(byte_ids)}
        # Ids that stand for the same text wherever they are.
        self.plain = self.spelled | {i: chr(b) for b, i in enumerate(byte_ids) if b < 128}

    @classmethod
    def load(cls, path: str) -> Encoder:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rule = model.normalizer_spec
        if rule.precompiled_charsmap or rule.remove_extra_whitespaces or not rule.add_dummy_prefix:
            raise ValueError("only models without text normalisation are supported")
        kinds = model.SentencePiece
        scores = {p.piece: (i, p.score) for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        byte_ids = [i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE]
        return cls(scores, byte_ids, model.trainer_spec.model_type == 2)

    def merge(self, text: str) -> list[str]:
        """The merges of a BPE model: the best score first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, where = None, 0
            for i in range(len(parts) - 1):
                found = self.scores.get(parts[i] + parts[i + 1])
                if found and (best is None or found[1] > best):
                    best, where = found[1], i
            if best is None:
                break
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def weight(self, before: str, piece: str) -> float:
        """Weight of ``piece`` after ``before``, which is empty at the start."""
        if not self.bpe:
            found = self.scores.get(piece)
            return found[1] if found else self.unknown
        if self.pairs >= PAIR_BYTES:
            self.apart.clear()
            self.pairs = 0
        # A place in a table; the model's own text of a piece is its key.
        self.pairs += 64 if piece in self.scores else _ENTRY
        apart = self.merge(before + piece) == ([before, piece] if before else [piece])
        return 0.0 if apart else _NONE

    def edges_from(self, text: str, start: int) -> list[Edge]:
        """The pieces that match at ``start``; a character without a piece is an edge of its own."""
        found = [(start, start + 1)]
        for end in range(start + 2, len(text) + 1):
            match = self.matches.get(text[start:end])
            if match is None:
                break
            if match:
                found.append((start, end))
        return found

    def states(self, text: str, cut: int) -> list[Edge]:
        """The edges that cover the character before a cut."""
        starts = range(max(0, cut - self.longest), cut)
        return [e for s in starts for e in self.edges_from(text, s) if e[1] >= cut]

    def _step(self, node: Node, char: str) -> Node:
        """Where ``char`` leads from ``node``: the longest beginning of a piece that the text now ends with."""
        if self.steps >= STEP_BYTES:
            self.nodes, self.steps = {"": ({}, (), "")}, 0
        so_far = node[2] + char
        while so_far and so_far not in self.matches:
            so_far = so_far[1:]
        found = self.nodes.get(so_far) if so_far else None
        if found is None:
            ends = [so_far[i:] for i in range(len(so_far) - 1)] if so_far else []
            # A character is an edge of its own, with or without a piece.
            ends = [self.matches[e] for e in ends if self.matches.get(e)] + [self.matches.get(char) or char]
            follow = {} if so_far else self.nodes[""][0]
            found = follow, tuple((e, len(e)) for e in ends), so_far
            if so_far:
                self.nodes[so_far] = found
            self.steps += 3 * _ENTRY + 100 * len(ends)
        node[0][char] = found
        self.steps += 100
        return found

    def _begins(self, text: str, entry: Edge, right: int) -> list[int]:
        """Of a BPE model: the start of the last edge of the path from ``entry`` that ends at each position, -1 for none.

        Edges start before ``right``. A position has one path at most, so the pieces
        that end there are tried until one stays apart from what is before it.
        """
        first, at = entry
        apart, most = self.apart, min(len(text), right - 1 + max(self.longest, 1))
        begins = [-1] * (most + 1)
        # The verdicts of the edge that ends at a position from which edges may start.
        told: list[dict | None] = [None] * (most + 1)
        begins[at] = first
        if at < right:
            told[at] = self._verdicts(text[first:at])
        node = self.nodes[""]
        for end in range(at + 1, most + 1):
            char = text[end - 1]
            node = node[0].get(char) or self._step(node, char)
            for piece, size in node[1]:
                start = end - size
                if start < at:
                    continue
                verdicts = told[start]
                if verdicts is None:
                    continue
                step = verdicts.get(piece)
                if step is None:
                    step = verdicts[piece] = self.weight(text[begins[start] : start], piece)
                if step != _NONE:
                    begins[end] = start
                    if end < right:
                        told[end] = apart.get(piece) or self._verdicts(piece)
                    break
        return begins

    def _verdicts(self, before: str) -> dict[str, float]:
        """What is kept of the pieces after ``before``."""
        found = self.apart.get(before)
        if found is None:
            found = self.apart[before] = {}
            self.pairs += 3 * _ENTRY + 2 * len(before)
        return found

    def _forward(self, text: str, entry: Edge, left: int, right: int) -> dict[int, tuple[float, int]]:
        """Best weight and start of the last edge, by the position where a path from ``entry`` ends.

        One edge for each position is enough: the weight of what follows depends
        on the edge before only in a BPE model, where no position is reached by
        two paths from the same entry.
        """
        if self.bpe:
            return {j: (0.0, i) for j, i in enumerate(self._begins(text, entry, right)) if i >= 0}
        first, at = entry
        reached = {at: (0.0, first)}
        matches, size = self.matches.get, len(text)
        for start in range(at, right):
            state = reached.get(start)
            if state is None:
                continue
            value, begin = state
            before = text[begin:start]
            verdicts = self._verdicts(before)
            verdict, one = verdicts.get, start + 1
            for end in range(one, size + 1):
                piece = text[start:end]
                step = verdict(piece)
                if step is None:
                    match = matches(piece)
                    if not match and end > one:
                        if match is None:
                            break
                        continue
                    step = verdicts[match or piece] = self.weight(before, piece)
                if step != _NONE:
                    best = reached.get(end)
                    if best is None or best[0] < value + step:
                        reached[end] = (value + step, start)
        return reached

    def transfer(self, text: str, entry: list[Edge], exit_: list[Edge], left: int, right: int) -> np.ndarray:
        """Max-plus matrix from the states at ``left`` to the states at ``right``."""
        rows = []
        for edge in entry:
            reached = self._forward(text, edge, left, right)
            rows.append([reached[j][0] if reached.get(j, (0, -1))[1] == i else _NONE for i, j in exit_])
        return np.array(rows)

    @staticmethod
    def _trace(reached: dict[int, tuple[float, int]], entry: Edge, exit_: Edge) -> list[Edge]:
        """The edges after ``entry`` up to ``exit_``."""
        path, (start, end) = [], exit_
        while (start, end) != entry:
            path.append((start, end))
            start, end = reached[start][1], start
        return path[::-1]

    def path(self, text: str, chunk: int = CHUNK) -> list[str]:
        """The best path of a text as its pieces."""
        if len(text) <= chunk and self.bpe:
            begins, at, pieces = self._begins(text, (0, 0), len(text)), len(text), []
            while at:
                pieces.append(text[begins[at] : at])
                at = begins[at]
            return pieces[::-1]
        if len(text) <= chunk:
            reached = self._forward(text, (0, 0), 0, len(text))
            exit_ = (reached[len(text)][1], len(text))
            return [text[a:b] for a, b in self._trace(reached, (0, 0), exit_)]
        cuts = [*range(chunk, len(text), chunk), len(text)]
        states = [[(0, 0)], *[self.states(text, c) for c in cuts]]
        left = [0, *cuts[:-1]]
        matrices = [
            self.transfer(text, a, b, lo, hi)
            for a, b, lo, hi in zip(states, states[1:], left, cuts, strict=False)
        ]
        reached = [m[0] for m in prefix_scan(matrices)]
        at = int(reached[-1].argmax())
        chosen = [states[-1][at]]
        for k in range(len(cuts) - 1, 0, -1):
            at = int((reached[k - 1] + matrices[k][:, at]).argmax())
            chosen.append(states[k][at])
        chosen = [(0, 0), *chosen[::-1]]
        pieces = []
        for a, b, lo, hi in zip(chosen, chosen[1:], left, cuts, strict=False):
            if a != b:
                pieces += [text[i:j] for i, j in self._trace(self._forward(text, a, lo, hi), a, b)]
        return pieces

    def _ids(self, stretch: str) -> bytes:
        ids = []
        for piece in self.path(stretch.replace(" ", BLANK)):
            found = self.scores.get(piece)
            ids += [found[0]] if found else [self.byte_ids[b] for b in piece.encode("utf-8", "replace")]
        return array("i", ids).tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text, without begin or end; none for null and empty texts."""
        if not text:
            return np.empty(0, np.int32)
        # Few texts hold the mark itself; the others are cut as they are, which is faster and keeps shorter texts.
        if BLANK in text:
            stretches = self.stretches(BLANK + text.replace(" ", BLANK))
        else:
            stretches = self.plain_stretches(f" {text}")
        kept, found = self.kept, []
        for stretch in stretches:
            ids = kept.get(stretch)
            if ids is None:
                ids = self.older.get(stretch)
                if ids is None:
                    ids = self._ids(stretch)
                if len(stretch) <= CHUNK:
                    if self.bytes >= KEPT_BYTES // 2:
                        # What was met since the last time stays, as the older half.
                        self.older, self.kept, self.bytes = kept, {}, 0
                        kept = self.kept
                    kept[stretch] = ids
                    self.bytes += _ENTRY + len(stretch) + len(ids)
            found.append(ids)
        return np.frombuffer(b"".join(found), np.int32)

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """Text of ids; invalid bytes become U+FFFD, ids without a piece are left out."""
        try:
            text = "".join(map(self.plain.__getitem__, np.asarray(ids).tolist())).replace(BLANK, " ")
            return text[1:] if text.startswith(" ") else text
        except KeyError:
            # Characters of several bytes, or ids without a piece, take the longer way.
            pass
        parts, held = [], bytearray()
        for i in np.asarray(ids).tolist():
            byte = self.byte_of.get(i)
            if byte is not None:
                held.append(byte)
                continue
            if held:
                parts.append(held.decode("utf-8", "replace"))
                held.clear()
            parts.append(self.spelled.get(i, ""))
        parts.append(held.decode("utf-8", "replace"))
        text = "".join(parts).replace(BLANK, " ")
        return text[1:] if text.startswith(" ") else text


@cache
def encoder(path: str) -> Encoder:
    """One encoder for each model in a Python worker."""
    return Encoder.load(path)


def _model(path: str | None) -> Encoder:
    import public_tokenizers

    return encoder(path or public_tokenizers.path(MODEL))


def piece_ids(text: Column, path: str | None = None) -> Column:
    """Ids of a text column as ``array<int>``; empty for null and empty texts."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        own = _model(path)
        found = [own.encode(t.as_py()) for t in texts]
        ends = np.cumsum([0, *map(len, found)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), np.concatenate([*found, np.empty(0, np.int32)]))

    return encode(text)


def piece_text(ids: Column, path: str | None = None) -> Column:
    """Text of a column of ids; empty for null and empty arrays."""

    @F.arrow_udf("string")
    def decode(rows: pa.Array) -> pa.Array:
        own = _model(path)
        return pa.array([own.decode(r.values.to_numpy()) if r.is_valid else "" for r in rows], pa.string())

    return decode(ids)


def checked_ids(text: Column, path: str | None = None) -> Column:
    """``ids`` of a text column, and ``same``: whether decoding them gives the text back."""

    @F.arrow_udf("ids array<int>, same boolean")
    def encode(texts: pa.Array) -> pa.Array:
        own = _model(path)
        found, same = [], []
        for text in texts:
            said = text.as_py() or ""
            ids = own.encode(said)
            found.append(ids)
            same.append(own.decode(ids) == said)
        ends = np.cumsum([0, *map(len, found)])
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), np.concatenate([*found, np.empty(0, np.int32)]))
        return pa.StructArray.from_arrays([ids, pa.array(same, pa.bool_())], ["ids", "same"])

    return encode(text)


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with ``piece_ids``, ``n_pieces`` and ``round_trip``.

    ``round_trip`` tells whether decoding gives the text back; it is false only
    for texts that hold the blank mark itself. Null counts as empty. Columns of
    these names are replaced; repeated rows give repeated results.
    """
    # Only the text goes through Python; the other columns wait in their rows.
    encoded = docs.withColumn("piece_ids", checked_ids(F.col("text"), path))
    found = encoded.withColumns(
        {"n_pieces": F.size("piece_ids.ids").cast("long"), "round_trip": F.col("piece_ids.same")}
    )
    return found.withColumn("piece_ids", F.col("piece_ids.ids"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number of pieces, digest of the comma-joined ids, and whether decoding gives the text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs).select(
        "doc_id",
        "n_pieces",
        F.sha2(F.array_join(F.col("piece_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        "round_trip",
    )
