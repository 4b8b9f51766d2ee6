"""Quality score of a text by a byte-level convolutional network in numpy.

Bytes are embedded, learned filters of eight bytes run over overlapping chunks
that cover the whole text, and each chunk keeps the strongest answer of every
filter and its mean. A chunk gets one logit from these; the mean and the lowest
logit of a text are combined into one probability. Fitting reads a bounded
sample of labelled rows, scoring reads every byte.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm.common import crc_remainder, table
from cohortline.plans.durable import freeze

# The classifier is fitted on at most this many labelled rows of each class,
# taken by hash of their id from texts of at most this many bytes.
SAMPLE_ROWS = 1_000
SAMPLE_BYTES = 1 << 16
CHUNK, STEP = 512, 448
_WIDTH, _STRIDE, _DIM, _FILTERS = 8, 2, 8, 32
_WINDOWS = CHUNK // _STRIDE - _WIDTH // _STRIDE + 1
_EPOCHS, _BATCH, _RATE = 8, 64, 0.004
_SEED = 17


def chunks(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping chunks of the bytes of a text, one row each, and how many bytes of each are text."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    count = max(1, -(-max(len(data) - CHUNK, 0) // STEP) + 1)
    padded = np.zeros((count - 1) * STEP + CHUNK, np.uint8)
    padded[: len(data)] = data
    sizes = np.clip(len(data) - np.arange(count) * STEP, 0, CHUNK)
    return np.lib.stride_tricks.as_strided(padded, (count, CHUNK), (STEP, 1)), sizes


class Network:
    """The weights; ``pack`` and ``unpack`` turn them into bytes and back."""

    names = ("embed", "filters", "bias", "weight", "final")

    def __init__(self, **weights: np.ndarray) -> None:
        self.__dict__.update(weights)

    @classmethod
    def fresh(cls) -> Network:
        rng = np.random.default_rng(_SEED)
        return cls(
            embed=rng.normal(0, 0.5, (256, _DIM)).astype(np.float32),
            filters=rng.normal(0, 0.2, (_WIDTH * _DIM, _FILTERS)).astype(np.float32),
            bias=np.zeros(_FILTERS, np.float32),
            weight=np.zeros(2 * _FILTERS + 3, np.float32),
            final=np.array([1.0, 0.0, 0.0]),
        )

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{n: getattr(self, n) for n in self.names})
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> Network:
        with np.load(io.BytesIO(data)) as held:
            return cls(**{n: held[n] for n in cls.names})

    def convolve(self, block: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """``(chunks, windows, filters)`` answers; a window starts at every second byte of text."""
        pairs = self.embed[block].reshape(len(block), CHUNK // _STRIDE, _STRIDE * _DIM)
        parts = np.split(self.filters, _WIDTH // _STRIDE)
        answer = pairs[:, :_WINDOWS] @ parts[0]
        for i, part in enumerate(parts[1:], 1):
            answer += pairs[:, i : i + _WINDOWS] @ part
        answer += self.bias
        np.maximum(answer, 0, out=answer)
        for row in np.flatnonzero(sizes < CHUNK):
            answer[row, _windows(sizes[row]) :] = 0
        return answer

    def features(self, answer: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        windows = _windows(sizes)[:, None].astype(np.float32)
        # A short chunk meets fewer windows, so its maxima are smaller: the head sees how many.
        few = np.log(_WINDOWS / windows)
        return np.concatenate([answer.max(1), answer.sum(1) / windows, few, few * few, np.ones_like(few)], axis=1)

    def logits(self, block: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        found = []
        for i in range(0, len(block), 128):
            some = sizes[i : i + 128]
            found.append(self.features(self.convolve(block[i : i + 128], some), some) @ self.weight)
        return np.concatenate(found)

    def score(self, text: str | None) -> float:
        logits = self.logits(*chunks(text))
        mean, low, level = self.final
        return float(_sigmoid(mean * logits.mean() + low * logits.min() + level))


def _windows(sizes: np.ndarray) -> np.ndarray:
    """Windows that start in the text of a chunk; an empty chunk counts as one."""
    return np.clip(-(-np.asarray(sizes) // _STRIDE), 1, _WINDOWS)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(np.asarray(x, np.float64) / 2))


def _adam(state: dict, name: str, value: np.ndarray, grad: np.ndarray) -> np.ndarray:
    m, v, t = state.get(name, (0.0, 0.0, 0))
    m, v, t = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad, t + 1
    state[name] = m, v, t
    return (value - _RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)).astype(value.dtype)


def fit(texts: list[str], labels: list[int]) -> Network:
    """Train on texts with labels 0 or 1; classes weigh the same however many rows they have."""
    net = Network.fresh()
    label = np.asarray(labels, np.float32)
    if len(set(labels)) < 2:
        net.final = np.array([0.0, 0.0, 4.0 if len(labels) and label[0] else 0.0])
        return net
    cut = [chunks(t) for t in texts]
    owner = np.repeat(np.arange(len(cut)), [len(c) for c, _ in cut])
    block, sizes = np.concatenate([c for c, _ in cut]), np.concatenate([n for _, n in cut])
    # A text's chunks share its weight, a class's texts the weight of the class.
    weight = (1 / np.bincount(owner))[owner] / np.bincount(label.astype(int))[label.astype(int)][owner]
    # Each epoch draws a few chunks from every text, so long ones do not take over,
    # and shortens some, so that short texts are known too.
    rng, state = np.random.default_rng(_SEED), {}
    for _ in range(_EPOCHS):
        draw = rng.choice(len(block), size=min(len(block), 2 * len(cut)), p=weight / weight.sum())
        for start in range(0, len(draw), _BATCH):
            some = draw[start : start + _BATCH]
            short = np.where(rng.random(len(some)) < 0.4, 2 ** rng.uniform(3, 9, len(some)), CHUNK).astype(int)
            length = np.minimum(sizes[some], short)
            seen = np.where(np.arange(CHUNK) < length[:, None], block[some], 0).astype(np.uint8)
            _step(net, state, seen, length, label[owner[some]])
    logits = net.logits(block, sizes)
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner))[:-1]])
    means = np.add.reduceat(logits, ends) / np.bincount(owner)
    design = np.stack([means, np.minimum.reduceat(logits, ends), np.ones(len(cut))], axis=1)
    net.final = _logistic(design, label, (0.5 / np.bincount(label.astype(int)))[label.astype(int)])
    return net


def _step(net: Network, state: dict, block: np.ndarray, sizes: np.ndarray, label: np.ndarray) -> None:
    answer = net.convolve(block, sizes)
    feature = net.features(answer, sizes)
    error = (_sigmoid(feature @ net.weight) - label).astype(np.float32) / len(block)
    rows, filters = np.arange(len(block))[:, None], np.arange(_FILTERS)[None, :]
    best = answer.argmax(1)
    # The strongest window takes the gradient of the maximum; the mean spreads its own.
    share = error[:, None] * net.weight[_FILTERS : 2 * _FILTERS] / _windows(sizes)[:, None].astype(np.float32)
    upward = np.broadcast_to(share[:, None, :], answer.shape).copy()
    upward[rows, best, filters] += error[:, None] * net.weight[:_FILTERS]
    upward *= answer > 0
    grad_weight = feature.T @ error + 1e-4 * net.weight
    pairs = net.embed[block].reshape(len(block), -1, _STRIDE * _DIM)
    flat = upward.reshape(-1, _FILTERS)
    grad_filters, grad_pairs = [], np.zeros_like(pairs)
    for i, part in enumerate(np.split(net.filters, _WIDTH // _STRIDE)):
        grad_filters.append(pairs[:, i : i + _WINDOWS].reshape(-1, _STRIDE * _DIM).T @ flat)
        grad_pairs[:, i : i + _WINDOWS] += upward @ part.T
    by_byte, seen = grad_pairs.reshape(-1, _DIM), block.ravel()
    grad_embed = np.stack([np.bincount(seen, by_byte[:, d], 256) for d in range(_DIM)], axis=1)
    net.embed = _adam(state, "embed", net.embed, grad_embed)
    net.filters = _adam(state, "filters", net.filters, np.concatenate(grad_filters))
    net.bias = _adam(state, "bias", net.bias, flat.sum(0))
    net.weight = _adam(state, "weight", net.weight, grad_weight)


def _logistic(design: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps with a small ridge."""
    found = np.zeros(design.shape[1])
    for _ in range(30):
        p = _sigmoid(design @ found)
        slope = design.T @ (weight * (p - label)) + 1e-3 * found
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(len(found))
        found = found - np.linalg.solve(curve, slope)
    return found


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``text, quality``: at most ``rows`` labelled rows of each class that are not held out."""
    usable = docs.select("doc_id", "text").filter(F.octet_length("text") <= SAMPLE_BYTES)
    known = labels.select("doc_id", "quality").filter(
        F.col("quality").isin(0, 1) & (crc_remainder(F.col("doc_id"), 4) != 2)
    )
    order = F.xxhash64("doc_id")
    # Ids are chosen before texts are read.
    chosen = freeze(
        known.filter("quality = 0").orderBy(order, "doc_id").limit(2 * rows)
        .unionByName(known.filter("quality = 1").orderBy(order, "doc_id").limit(2 * rows))
    )
    held = usable.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality")
    parts = [held.filter(F.col("quality") == q).orderBy(order, "doc_id", "text").limit(rows) for q in (0, 1)]
    return parts[0].unionByName(parts[1])


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Network:
    """Fit in one task on the bounded sample; the driver sees only the weights."""

    def learn(parts):
        texts, marks = [], []
        for part in parts:
            texts += part["text"].to_pylist()
            marks += part["quality"].to_pylist()
        yield pa.RecordBatch.from_pydict({"weights": [fit(texts, marks).pack()]})

    sample = freeze(training_sample(docs, labels, rows))
    # Row order decides the draws, so it is fixed before the fit.
    one = sample.repartition(1).sortWithinPartitions("quality", "doc_id", "text")
    packed = one.select("text", "quality").mapInArrow(learn, "weights binary").collect()
    return Network.unpack(bytes(packed[0][0])) if packed else fit([], [])


def score_of(network: Network, text: Column) -> Column:
    """Probability of quality 1 for a text column; null counts as empty."""
    packed = network.pack()

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Network.unpack(packed)
        for texts in parts:
            yield pd.Series([own.score(t) for t in texts], dtype="float64")

    return score(text)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    ``docs`` needs ``doc_id`` and ``text``, ``labels`` needs ``doc_id`` and
    ``quality``; other columns are ignored and no score depends on them. Null
    texts are scored as empty ones. Without labels of both classes every score is
    the same. Repeated rows give repeated results.
    """
    network = train(docs, labels)
    scored = docs.select("doc_id", score_of(network, F.col("text")).alias("score"))
    return scored.select(
        "doc_id",
        (crc_remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def drop_low_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns."""
    return docs.filter(score_of(train(docs, labels), docs["text"]) >= threshold)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
