"""Text scores of a log-bilinear model trained by noise-contrastive estimation.

Everything that is learned comes from all training texts. Words are counted; each
of the ``HEAD`` most frequent ones has a source vector for either place before a
token, a target vector and a bias of its own, and all rarer and unknown words
share those of the tail. A log-bilinear model of class triples, fitted on their
counts, gives the vectors to begin with. Spark passes over every training token
then train them: a task starts from the vectors sent to it, goes through its
tokens in batches with noise drawn from the word frequencies, and hands on what
it changed; the changes are averaged by blocks of words.

Head words lie in groups of at most ``GROUP``. The probability of a word is that
of its group after the two words before it times that of the word in its group,
both normalised by batched matrix products, so all words together, unknown ones
included, have probability one.

Counts of the most frequent words travel with the tasks. Rarer words are looked
up by a join; no key of it is hot, since frequent words are not in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm.common import crc_remainder, settle, table
from cohortline.plans.durable import freeze

# Words whose counts travel with the tasks, and the classes of the model.
HEAD = 1 << 17
SINGLE, SHARED = 96, 30
CLASSES = SINGLE + SHARED + 2
END = b""
_END, _TAIL = CLASSES - 2, CLASSES - 1
_DIM, _STEPS, _BATCH, _NOISE, _RATE = 32, 2_000, 2_048, 64, 0.01
_SMOOTH = 0.1
# Words of a group, passes over the training tokens, and what a pass works with.
GROUP, PASSES = 256, 1
_TOKENS, _WORD_NOISE, _STEP, _BLOCK = 4_096, 64, 0.05, 4_096
# Training tokens of a task, which hands on nearly all vectors: this bounds them by the size of the texts.
_SHARE = 1 << 23
# Distinct keys that a task counts before it hands them on.
_HELD = 1 << 18
# Words held as bytes at a time, at most, and numbers of words that are learnt and scored at a time.
_WORDS, _LEARNT, _SCORED = 1 << 20, 1 << 20, 1 << 20
# Rows of scores that stay in a cache, and the largest score whose exponential needs no shift.
_ROWS, _SAFE = 512, 60.0
_SEED = 29


def words(text: str | None) -> list[bytes]:
    """Lower-cased words in UTF-8, and the end of the text."""
    found = (text or "").encode("utf-8", "replace").lower().split()
    found.append(END)
    return found


def _split(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, pa.Array]]:
    """Blocks of rows of at most ``_WORDS`` words and a row: first row, row behind the last, words of each row, words.

    The words are those of ``words``, in one array.
    """
    # Words and blanks take turns, and the end is a word.
    most = np.cumsum((np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64) + 1) // 2 + 1)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(most, (most[first - 1] if first else 0) + _WORDS)) + 1
        last = min(last, len(texts))
        plain = pc.fill_null(pc.ascii_trim_whitespace(pc.ascii_lower(texts.slice(first, last - first))), "")
        # A blank at the end has an empty word behind it, which is the end; an empty text has no other word.
        ended = pc.if_else(pc.equal(plain, ""), plain, pc.binary_join_element_wise(plain, "", " "))
        lists = pc.ascii_split_whitespace(ended)
        yield first, last, np.diff(lists.offsets.to_numpy()), lists.flatten().cast(pa.binary())
        first = last


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, c`` over all rows of column ``text``."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for part in parts:
            for *_, found in _split(part["text"]):
                held.append(pa.table(found.value_counts().flatten(), ["word", "n"]))
                if sum(map(len, held)) >= 2 * _HELD:
                    held = [_added(held)]
                    if len(held[0]) >= _HELD:
                        yield from held[0].to_batches()
                        held = []
        if held:
            yield from _added(held).to_batches()

    partial = texts.select("text").mapInArrow(count, "word binary, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("c"))


def _added(counts: list[pa.Table]) -> pa.Table:
    summed = pa.concat_tables(counts).group_by("word", use_threads=False).aggregate([("n", "sum")])
    return summed.select(["word", "n_sum"]).rename_columns(["word", "n"])


def frequent_words(counts: DataFrame, distinct: int, most: int) -> list[tuple[bytes, int]]:
    """The most frequent words with their counts, at most ``most``; none of several that tie at the end.

    Rarer words are filtered out where they are, so about ``most`` rows reach the
    driver, however many tasks there are.
    """
    if distinct > most:
        least = counts.agg(F.percentile_approx("c", 1 - most / distinct, 100_000)).first()[0]
        counts = counts.filter(F.col("c") > least)
    return [(bytes(w), c) for w, c in counts.orderBy(F.desc("c"), "word").limit(most).collect()]


class Vocabulary:
    """Counts and classes of the most frequent words; all others are the tail."""

    def __init__(self, head: list[tuple[bytes, int]], total: int, distinct: int) -> None:
        self.head = pa.array([w for w, _ in head], pa.binary())
        counts = np.array([c for _, c in head] + [0], np.float64)
        self.total = total
        self.mass = total + _SMOOTH * (distinct + 1)
        # The tail has no count of its own here: its words are looked up.
        weight = counts + _SMOOTH
        self.classes = np.full(len(head) + 1, _TAIL, np.int64)
        end = self.head.index(END).as_py()
        rest = np.array([i for i in range(len(head)) if i != end], np.int64)
        self.classes[rest[:SINGLE]] = np.arange(len(rest[:SINGLE]))
        shared = rest[SINGLE:]
        if len(shared):
            passed = np.cumsum(weight[shared]) - weight[shared]
            self.classes[shared] = SINGLE + (passed / weight[shared].sum() * SHARED).astype(int)
        if end >= 0:
            self.classes[end] = _END
        sums = np.bincount(self.classes[:-1], weight[:-1], CLASSES).astype(np.float64)
        sums[_TAIL] = max(self.mass - weight[:-1].sum(), _SMOOTH)
        self.used = sums > 0
        self.weight, self.sums = weight, sums
        self.base = np.log10(weight / self.mass)
        self.share = np.log10(weight) - np.log10(np.where(self.used, sums, 1))[self.classes]
        # A tail word adds the logarithm of its own weight later.
        self.base[-1] = -np.log10(self.mass)
        self.share[-1] = -np.log10(sums[_TAIL])

    def look_up(self, found: pa.Array) -> np.ndarray:
        """Number of each word; that of the tail is the number of head words."""
        return np.asarray(pc.fill_null(pc.index_in(found, value_set=self.head), len(self.head)), np.int64)


def _contexts(classes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Number of the two classes before each token; texts begin after two ends."""
    before = np.concatenate([[_END], classes[:-1]])
    before[starts] = _END
    earlier = np.concatenate([[_END], before[:-1]])
    earlier[starts] = _END
    return earlier * CLASSES + before


def _numbered(part: pa.RecordBatch, known: Vocabulary) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of rows of about ``_LEARNT`` words: where their texts begin, and the numbers of the words."""
    lengths, index = np.empty(0, np.int64), np.empty(0, np.int64)
    for _, _, more, found in _split(part["text"]):
        lengths, index = np.concatenate([lengths, more]), np.concatenate([index, known.look_up(found)])
        while len(index) >= _LEARNT:
            ends = np.cumsum(lengths)
            rows = int(np.searchsorted(ends, _LEARNT)) + 1
            size = int(ends[rows - 1])
            yield ends[:rows] - lengths[:rows], index[:size]
            lengths, index = lengths[rows:], index[size:]
    if len(lengths):
        yield np.cumsum(lengths) - lengths, index


def class_counts(texts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``context, followers``: after each pair of classes, the ``(class, n)`` that occur."""
    sent = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None
        for part in parts:
            for starts, index in _numbered(part, sent.value):
                classes = sent.value.classes[index]
                codes = _contexts(classes, starts) * CLASSES + classes
                counted = np.bincount(codes, minlength=CLASSES**3)
                held = counted if held is None else held + counted
        codes = np.flatnonzero(held) if held is not None else np.empty(0, np.int64)
        for start in range(0, len(codes), 1 << 16):
            some = codes[start : start + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["code", "n"])

    partial = dealt(texts, vocabulary.total).mapInArrow(count, "code long, n long")
    counts = partial.groupBy("code").agg(F.sum("n").alias("n"))
    # One list holds at most one entry for each class.
    return counts.groupBy(F.expr(f"code div {CLASSES}").alias("context")).agg(
        F.collect_list(F.struct((F.col("code") % CLASSES).alias("class"), "n")).alias("followers")
    )


class LogBilinear:
    """Class vectors, a diagonal map for each of the two places, target vectors and biases."""

    def __init__(self, unigram: np.ndarray) -> None:
        rng = np.random.default_rng(_SEED)
        self.source = rng.normal(0, 0.1, (2, CLASSES, _DIM))
        self.place = np.ones((2, _DIM))
        self.target = rng.normal(0, 0.1, (CLASSES, _DIM))
        self.bias = np.log(unigram)

    def predicted(self, contexts: np.ndarray) -> np.ndarray:
        earlier, before = contexts // CLASSES, contexts % CLASSES
        return self.source[0][earlier] * self.place[0] + self.source[1][before] * self.place[1]

    def log_probabilities(self) -> np.ndarray:
        """``log10 P(class | pair)`` for all pairs, by batched matrix products."""
        parts = []
        for start in range(0, CLASSES**2, 4096):
            scores = self.predicted(np.arange(start, min(start + 4096, CLASSES**2))) @ self.target.T + self.bias
            top = scores.max(1, keepdims=True)
            scores -= top + np.log(np.exp(scores - top).sum(1, keepdims=True))
            parts.append((scores / np.log(10)).astype(np.float32))
        return np.concatenate(parts)


def fit(contexts: np.ndarray, classes: np.ndarray, counts: np.ndarray, used: np.ndarray) -> LogBilinear:
    """Noise-contrastive estimation on weighted ``(context, class)`` pairs, with Adam."""
    order = np.lexsort((classes, contexts))
    contexts, classes, counts = contexts[order], classes[order], counts[order].astype(np.float64)
    unigram = np.bincount(classes, counts, CLASSES) + _SMOOTH
    # A class without any word has practically no probability.
    unigram = np.where(used, unigram, 1e-12)
    unigram /= unigram.sum()
    model = LogBilinear(unigram)
    if not len(counts):
        return model
    rng = np.random.default_rng(_SEED)
    upto, noise_upto = np.cumsum(counts) / counts.sum(), np.cumsum(unigram)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (model.source, model.place, model.target, model.bias)]
    shift = np.log(_NOISE * unigram)
    for step in range(1, _STEPS + 1):
        drawn = np.minimum(np.searchsorted(upto, rng.random(_BATCH)), len(counts) - 1)
        noise = np.minimum(np.searchsorted(noise_upto, rng.random(_NOISE)), CLASSES - 1)
        context, truth = contexts[drawn], classes[drawn]
        hidden = model.predicted(context)
        good = (hidden * model.target[truth]).sum(1) + model.bias[truth] - shift[truth]
        bad = hidden @ model.target[noise].T + model.bias[noise] - shift[noise]
        pull = (1 / (1 + np.exp(-good)) - 1) / _BATCH
        push = 1 / (1 + np.exp(-bad)) / _BATCH
        grad_hidden = pull[:, None] * model.target[truth] + push @ model.target[noise]
        grad_target = _gather(truth, pull[:, None] * hidden) + _gather(noise, push.T @ hidden)
        grad_bias = np.bincount(truth, pull, CLASSES) + np.bincount(noise, push.sum(0), CLASSES)
        rows = context // CLASSES, context % CLASSES
        grad_source = np.stack([_gather(r, grad_hidden * p) for r, p in zip(rows, model.place, strict=True)])
        grad_place = np.stack([(grad_hidden * s[r]).sum(0) for s, r in zip(model.source, rows, strict=True)])
        rate = _RATE * (1 - step / (_STEPS + 1))
        parameters = model.source, model.place, model.target, model.bias
        for p, g, (m, v) in zip(parameters, (grad_source, grad_place, grad_target, grad_bias), moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def _gather(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of the values of each class."""
    return (np.arange(CLASSES)[:, None] == rows).astype(np.float64) @ values


def train(texts: DataFrame, vocabulary: Vocabulary) -> LogBilinear:
    """Count class triples over all rows and fit in one task, which sees at most ``CLASSES ** 2`` rows."""
    used = vocabulary.used

    def learn(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts, classes, counts = [], [], []
        for part in parts:
            lists = part["followers"]
            contexts.append(np.repeat(part["context"].to_numpy(), np.diff(lists.offsets.to_numpy())))
            flat = lists.flatten()
            classes.append(flat.field("class").to_numpy())
            counts.append(flat.field("n").to_numpy())
        empty = [np.empty(0, np.int64)]
        model = fit(*(np.concatenate(x + empty) for x in (contexts, classes, counts)), used)
        names = ("source", "place", "target", "bias")
        yield pa.RecordBatch.from_pydict({"name": names, "data": [getattr(model, n).tobytes() for n in names]})

    counts = settle(class_counts(texts, vocabulary))
    model = LogBilinear(np.where(used, 1.0, 1e-12) / max(used.sum(), 1))
    for name, data in counts.repartition(1).mapInArrow(learn, "name string, data binary").collect():
        setattr(model, name, np.frombuffer(bytes(data)).reshape(getattr(model, name).shape))
    return model


class WordModel:
    """Vectors of all head words, of the tail and of the start of a text, in groups of words.

    ``source`` has a row for each head word, the tail and the start, for either
    place; ``target`` has one for each head word and ``top`` one for each group.
    The last column of ``target`` and ``top`` is the bias.
    """

    names = ("source0", "source1", "target", "top")

    def __init__(self, known: Vocabulary, classes: LogBilinear) -> None:
        head = len(known.head)
        self.tail, self.start = head, head + 1
        self.group = np.zeros(head + 1, np.int64)
        self.members: list[np.ndarray] = []
        first, mass = [], []
        for c in np.flatnonzero(known.used):
            words_ = np.flatnonzero(known.classes[:-1] == c)
            for start in range(0, len(words_), GROUP) if c != _TAIL else (0,):
                some = words_[start : start + GROUP] if c != _TAIL else words_[:0]
                self.group[some if c != _TAIL else [head]] = len(first)
                self.members.append(some)
                first.append(c)
                mass.append(known.weight[some].sum() if c != _TAIL else known.sums[c])
        first, mass = np.array(first), np.array(mass)
        self.unigram = mass / mass.sum()
        # Only words that share a group are told apart by a second step.
        alone = np.array([len(m) < 2 for m in self.members])
        self.shared = ~alone[self.group]
        weight = np.where(self.shared, known.weight, 0)[:-1]
        self.words = weight / max(weight.sum(), 1e-300)
        # The place of each word among those of its group.
        self.inside = np.zeros(head + 1, np.int64)
        for some in self.members:
            self.inside[some] = np.arange(len(some))
        rows = np.concatenate([known.classes, [_END]])
        for place in (0, 1):
            setattr(self, f"source{place}", (classes.source[place] * classes.place[place])[rows].astype(np.float32))
        bias = classes.bias[first] + np.log(mass / known.sums[first])
        self.top = np.column_stack([classes.target[first], bias]).astype(np.float32)
        rng = np.random.default_rng(_SEED)
        with np.errstate(divide="ignore"):
            bias = np.where(self.shared[:-1], np.log(self.words), 0)
        self.target = np.column_stack([rng.normal(0, 0.01, (head, _DIM)), bias]).astype(np.float32)

    def contexts(self, index: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The two words before each token; texts begin after two starts."""
        before = np.concatenate([[self.start], index[:-1]])
        before[starts] = self.start
        earlier = np.concatenate([[self.start], before[:-1]])
        earlier[starts] = self.start
        return earlier, before

    def log_probabilities(self, index: np.ndarray, earlier: np.ndarray, before: np.ndarray) -> np.ndarray:
        """``log10`` of each word after its two; of a tail word, that of the whole tail."""
        parts = [self._logs(*(x[i : i + _SCORED] for x in (index, earlier, before))) for i in range(0, len(index), _SCORED)]
        return np.concatenate(parts) / np.log(10) if parts else np.empty(0)

    def _logs(self, index: np.ndarray, earlier: np.ndarray, before: np.ndarray) -> np.ndarray:
        # Tokens by their pair, so that scores are read where they are made. A key and a
        # place in one number sort faster than by an index, and in the same order.
        bits, places = len(index).bit_length(), np.arange(len(index))
        order = np.sort((earlier * (self.start + 1) + before) << bits | places)
        pairs = order >> bits
        order &= (1 << bits) - 1
        fresh = np.diff(pairs, prepend=-1) > 0
        pairs, which = np.divmod(pairs[fresh], self.start + 1), np.cumsum(fresh) - 1
        room = np.empty(_ROWS * max(len(self.top), *map(len, self.members)), np.float32)
        index = index[order]
        group = self.group[index]
        sums, scores = self._log_sums(*pairs, self.top, which, group, room)
        logs = scores - sums[which]
        chosen = np.flatnonzero(self.shared[index])
        # Within a group the pairs still rise.
        chosen = np.sort(group[chosen] << bits | chosen) & (1 << bits) - 1
        which, group, inside = which[chosen], group[chosen], self.inside[index[chosen]]
        start = 0
        for end in (np.flatnonzero(np.diff(group, append=-1)) + 1).tolist():
            members, mine = self.members[group[start]], which[start:end]
            first = np.diff(mine, prepend=-1) > 0
            rows, mine = np.cumsum(first) - 1, mine[first]
            sums, scores = self._log_sums(*(p[mine] for p in pairs), self.target[members], rows, inside[start:end], room)
            logs[chosen[start:end]] += scores - sums[rows]
            start = end
        found = np.empty(len(logs))
        found[order] = logs
        return found

    def _log_sums(
        self, earlier: np.ndarray, before: np.ndarray, table: np.ndarray, rows: np.ndarray, columns: np.ndarray, room: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Logarithm of the summed exponentials of the scores of ``table`` by pair, and the scores at rising ``rows``.

        Only ``_ROWS`` rows of scores are made at a time, in ``room``, which saves asking for memory each time.
        """
        size, width = len(earlier), len(table)
        sums, wanted = np.empty(size), np.empty(len(rows), np.float32)
        ones, hidden = np.ones(width, np.float32), np.ones((_ROWS, _DIM + 1), np.float32)
        # No score is larger than the lengths of its two vectors allow.
        longest = np.sqrt(np.einsum("ij,ij->i", table, table).max())
        cuts = np.searchsorted(rows, np.arange(0, size + _ROWS, _ROWS)).tolist()
        for start, a, b in zip(range(0, size, _ROWS), cuts, cuts[1:]):
            end = min(start + _ROWS, size)
            own = hidden[: end - start]
            np.add(self.source0[earlier[start:end]], self.source1[before[start:end]], out=own[:, :-1])
            scores = np.matmul(own, table.T, out=room[: len(own) * width].reshape(len(own), width))
            wanted[a:b] = scores[rows[a:b] - start, columns[a:b]]
            # Rows are shifted by their largest score where one may be far from zero.
            top = 0.0
            if not np.sqrt(np.einsum("ij,ij->i", own, own).max()) * longest <= _SAFE:
                top = scores.max(1)
                scores -= top[:, None]
            sums[start:end] = np.log(np.exp(scores, out=scores) @ ones) + top
        return sums, wanted


def _taken(table: np.ndarray, rows: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Rows of a table, in ``room``."""
    return np.take(table, rows, axis=0, out=room[: len(rows)], mode="clip")


class Learner:
    """Noise-contrastive training of a copy of the vectors, with a step for each row by its past gradients."""

    def __init__(self, model: WordModel, seed: int = 0) -> None:
        self.model = model
        self.own = {n: getattr(model, n).copy() for n in model.names}
        self.past = {n: np.full(len(x), 1e-6, np.float32) for n, x in self.own.items()}
        self.times = {n: np.zeros(len(x), np.int64) for n, x in self.own.items()}
        self.rng = np.random.default_rng([_SEED, seed])
        # Room for the arrays of a batch; asking for it each time costs more than filling it.
        most = _TOKENS + max(_NOISE, _WORD_NOISE)
        names = ("hidden", "chosen", "back", "true", "more", "grad", "sorted", "sums")
        self.room = {n: np.empty((most, _DIM + 1), np.float32) for n in names}
        self.left, self.right = (np.empty((most, _DIM), np.float32) for _ in range(2))
        self.room["push"] = np.empty(_TOKENS * max(_NOISE, _WORD_NOISE), np.float32)
        self.top_upto, self.upto = np.cumsum(model.unigram), np.cumsum(model.words)
        with np.errstate(divide="ignore"):
            self.top_shift = np.log(_NOISE * model.unigram).astype(np.float32)
            self.shift = np.log(_WORD_NOISE * model.words).astype(np.float32)

    def learn(self, index: np.ndarray, earlier: np.ndarray, before: np.ndarray) -> None:
        """One pass over the tokens."""
        for i in range(0, len(index), _TOKENS):
            self._batch(*(x[i : i + _TOKENS] for x in (index, earlier, before)))

    def _batch(self, index: np.ndarray, earlier: np.ndarray, before: np.ndarray) -> None:
        own, known, room, size = self.own, self.model, self.room, len(index)
        hidden = room["hidden"][:size]
        hidden[:, -1] = 1
        left, right = _taken(own["source0"], earlier, self.left), _taken(own["source1"], before, self.right)
        np.add(left, right, out=hidden[:, :-1])
        back = self._contrast("top", known.group[index], hidden, self.top_upto, self.top_shift, _NOISE, room["back"])
        rows = np.flatnonzero(known.shared[index])
        if len(rows):
            chosen = _taken(hidden, rows, room["chosen"])
            back[rows] += self._contrast("target", index[rows], chosen, self.upto, self.shift, _WORD_NOISE, room["true"])
        change = self.left[:size]
        change[:] = back[:, :-1]
        self._move("source0", earlier, change)
        self._move("source1", before, change)

    def _contrast(
        self, name: str, truth: np.ndarray, hidden: np.ndarray, upto: np.ndarray, shift: np.ndarray, times: int, room: np.ndarray
    ) -> np.ndarray:
        """Tell the true rows from noise; the gradient of ``hidden``, in ``room``."""
        table, size = self.own[name], len(truth)
        noise = np.minimum(np.searchsorted(upto, self.rng.random(times) * upto[-1], side="right"), len(table) - 1)
        true, other = _taken(table, truth, room), table[noise]
        good = np.einsum("ij,ij->i", hidden, true) - shift[truth]
        pull = (1 / (1 + np.exp(-good.clip(-30, 30))) - 1).astype(np.float32)[:, None]
        # The last of ``hidden`` is one, so the shift is taken off with the bias.
        away = -other
        away[:, -1] += shift[noise]
        push = np.matmul(hidden, away.T, out=self.room["push"][: size * times].reshape(size, times))
        with np.errstate(over="ignore"):
            np.exp(push, out=push)
        push += 1
        np.reciprocal(push, out=push)
        true *= pull
        true += np.matmul(push, other, out=self.room["more"][:size])
        grad = self.room["grad"][: size + times]
        np.multiply(pull, hidden, out=grad[:size])
        np.matmul(push.T, hidden, out=grad[size:])
        self._move(name, np.concatenate([truth, noise]), grad)
        return true

    def _move(self, name: str, rows: np.ndarray, grad: np.ndarray) -> None:
        # Row and place in one number sort faster than by an index, and in the same order.
        order = np.sort(rows << 16 | np.arange(len(rows)))
        rows = order >> 16
        at = np.flatnonzero(np.diff(rows, prepend=-1))
        rows, width = rows[at], grad.shape[1]
        grad = _taken(grad, order & 0xFFFF, self.room["sorted"].reshape(-1)[: len(order) * width].reshape(-1, width))
        sums = self.room["sums"].reshape(-1)[: len(at) * width].reshape(-1, width)
        # Two numbers at a time, where the width allows it, sum faster.
        two = np.float32 if width % 2 else np.complex64
        np.add.reduceat(grad.view(two), at, axis=0, out=sums.view(two))
        grad = sums
        past = self.past[name][rows] + np.einsum("ij,ij->i", grad, grad) / width
        self.past[name][rows] = past
        grad *= (_STEP / np.sqrt(past))[:, None]
        self.own[name][rows] -= grad
        self.times[name][rows] += np.diff(np.append(at, len(order)))

    def changes(self) -> Iterator[pa.RecordBatch]:
        """What moved, by blocks of rows: times each row took part, and its change so often."""
        for name in self.model.names:
            for block in range(0, len(self.own[name]), _BLOCK):
                times = self.times[name][block : block + _BLOCK]
                rows = np.flatnonzero(times)
                if len(rows):
                    moved = self.own[name][block + rows] - getattr(self.model, name)[block + rows]
                    yield _change(name, block, rows, times[rows], moved)


def _change(name: str, block: int, rows: np.ndarray, times: np.ndarray, moved: np.ndarray) -> pa.RecordBatch:
    data = [rows.astype(np.int32), times.astype(np.int64), moved.astype(np.float32)]
    columns = {"name": [name], "block": pa.array([block], pa.int64())}
    return pa.RecordBatch.from_pydict(columns | {n: [x.tobytes()] for n, x in zip(("rows", "times", "moved"), data, strict=True)})


_CHANGE = "name string, block long, rows binary, times binary, moved binary"


def _unpacked(name: str, rows: bytes, times: bytes, moved: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    width = _DIM + (not name.startswith("source"))
    return np.frombuffer(rows, np.int32), np.frombuffer(times, np.int64), np.frombuffer(moved, np.float32).reshape(-1, width)


def _averaged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mean change of each row, by the times it took part. A task holds only the blocks dealt to it."""
    held: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
    for part in parts:
        for r in part.to_pylist():
            rows, times, moved = _unpacked(r["name"], r["rows"], r["times"], r["moved"])
            key = r["name"], r["block"]
            if key not in held:
                held[key] = np.zeros(_BLOCK, np.int64), np.zeros((_BLOCK, moved.shape[1]))
            held[key][0][rows] += times
            held[key][1][rows] += times[:, None] * moved
    for (name, block), (times, moved) in held.items():
        rows = np.flatnonzero(times)
        yield _change(name, block, rows, times[rows], moved[rows] / times[rows, None])


def dealt(texts: DataFrame, total: int) -> DataFrame:
    """All texts in as few partitions as leave each about ``_SHARE`` of the ``total`` tokens."""
    return texts.select("text").coalesce(max(-(-total // _SHARE), 1))


def train_words(texts: DataFrame, vocabulary: Vocabulary, model: WordModel) -> WordModel:
    """Passes over every token of ``texts``; a pass brings each changed vector to the driver once."""
    context = texts.sparkSession.sparkContext
    known = context.broadcast(vocabulary)
    for nth in range(PASSES):
        sent = context.broadcast(model)

        def learn(parts: Iterator[pa.RecordBatch], nth: int = nth, sent: Broadcast = sent) -> Iterator[pa.RecordBatch]:
            learner = None
            for part in parts:
                for starts, index in _numbered(part, known.value):
                    if learner is None:
                        learner = Learner(sent.value, TaskContext.get().partitionId() * PASSES + nth)
                    learner.learn(index, *sent.value.contexts(index, starts))
            if learner is not None:
                yield from learner.changes()

        moved = dealt(texts, vocabulary.total).mapInArrow(learn, _CHANGE)
        for r in settle(moved.repartition("name", "block").mapInArrow(_averaged, _CHANGE)).toLocalIterator():
            rows, _, change = _unpacked(r["name"], bytes(r["rows"]), bytes(r["times"]), bytes(r["moved"]))
            getattr(model, r["name"])[r["block"] + rows] += change
        sent.destroy()
    known.destroy()
    return model


def _repeats(found: pa.Array, lengths: np.ndarray, wanted: np.ndarray) -> tuple[pa.ListArray, pa.ListArray]:
    """The distinct wanted words of each row, and how often each occurs in it."""
    coded = found.filter(pa.array(wanted)).dictionary_encode()
    rows, distinct = np.repeat(np.arange(len(lengths)), lengths)[wanted], max(len(coded.dictionary), 1)
    keys, times = np.unique(rows * distinct + coded.indices.to_numpy(), return_counts=True)
    offsets = pa.array(np.searchsorted(keys, np.arange(len(lengths) + 1) * distinct), pa.int32())
    own = coded.dictionary.take(pa.array(keys % distinct))
    return pa.ListArray.from_arrays(offsets, own), pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64()))


def _blocks(texts: pa.Array, known: Vocabulary) -> Iterator[tuple]:
    """Blocks of rows of fewer than ``_SCORED`` words, or little more.

    First row, row behind the last, words of each row, their numbers, and the tail words of each row with how often each occurs.
    """
    held, begin, size = [], 0, 0
    for _, last, lengths, found in _split(texts):
        index = known.look_up(found)
        held.append((lengths, index, *_repeats(found, lengths, index == len(known.head))))
        size += len(index)
        if 4 * size >= 3 * _SCORED or last == len(texts):
            lengths, index, *rare = zip(*held, strict=True)
            yield begin, last, np.concatenate(lengths), np.concatenate(index), *map(pa.concat_arrays, rare)
            held, begin, size = [], last, 0


def model_scores(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """Scores of ``docs`` under a model of all ``texts``: one row per row.

    ``doc_id, n_tokens, n_known, train_tokens, base_score, score``. Both tables
    need ``text``, ``docs`` also ``doc_id``; other columns are ignored. Null and
    empty texts are one end. Without training texts all words are unknown.
    Repeated rows give repeated results.
    """
    counts = settle(word_counts(texts))
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    vocabulary = Vocabulary(frequent_words(counts, distinct, HEAD), total, distinct)
    model = train_words(texts, vocabulary, WordModel(vocabulary, train(texts, vocabulary)))
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, model))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, net = sent.value
        tail = len(known.head)
        for part in parts:
            for first, last, lengths, index, *rare in _blocks(part["text"], known):
                starts = np.cumsum(lengths) - lengths
                token = net.log_probabilities(index, *net.contexts(index, starts)) + np.where(index < tail, 0, known.share[-1])
                sums = [np.add.reduceat(x, starts) for x in (known.base[index], token, (index < tail).astype(np.int64))]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"][first:last],
                        part["copy"][first:last],
                        pa.array(lengths, pa.int64()),
                        pa.array(sums[0]),
                        pa.array(sums[1]),
                        pa.array(sums[2]),
                        *rare,
                    ],
                    names,
                )

    names = ["doc_id", "copy", "n_tokens", "base", "score", "known", "words", "times"]
    schema = (
        f"doc_id {kind}, copy long, n_tokens long, base double, score double, known long,"
        " words array<binary>, times array<long>"
    )
    scored = freeze(docs.select("doc_id", "text", F.xxhash64("text").alias("copy")).mapInArrow(score, schema))
    # One row stands for the text itself, and one for each of its rare words.
    text = F.struct(F.lit(None).cast("binary").alias("words"), F.lit(0).cast("long").alias("times"))
    rows = scored.select(
        "doc_id", "copy", "n_tokens", "base", "score", "known",
        F.explode(F.concat(F.array(text), F.arrays_zip("words", "times"))).alias("w"),
    ).select("doc_id", "copy", "n_tokens", "base", "score", "known", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    own = rows.filter("word is null")
    rare = rows.filter("word is not null").select("doc_id", "copy", "word", "times")
    weighed = rare.join(counts, "word", "left").select(
        "doc_id",
        "copy",
        (F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + _SMOOTH)).alias("added"),
        F.when(F.col("c") > 0, F.col("times")).otherwise(0).alias("found"),
    )
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("n_tokens", "long"), ("base", "double"), ("score", "double"), ("known", "long"))]
    every = own.select(
        "doc_id", "copy", "n_tokens", "base", "score", "known",
        F.lit(0.0).alias("added"), F.lit(0).cast("long").alias("found"),
    ).unionByName(weighed.select("doc_id", "copy", *nothing, "added", "found"))
    # Repeated rows meet in one group and come back at the end.
    return (
        every.groupBy("doc_id", "copy")
        .agg(
            *[F.max(n).alias(n) for n in ("n_tokens", "base", "score", "known")],
            F.count("n_tokens").alias("copies"),
            F.sum("added").alias("added"),
            F.sum("found").alias("found"),
        )
        .select(
            "doc_id",
            "n_tokens",
            (F.col("known") + F.expr("found div copies")).alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            (F.col("base") + F.col("added") / F.col("copies")).alias("base_score"),
            (F.col("score") + F.col("added") / F.col("copies")).alias("score"),
            F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("nth"),
        )
        .drop("nth")
    )


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = crc_remainder(F.col("doc_id"), 10)
    scored = model_scores(docs, docs.filter(remainder != 0))
    return scored.withColumn("held_out", remainder == 0)
