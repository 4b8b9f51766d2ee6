"""The quality classifier and the language model: held-out accuracy, brute force and odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from cohortline.llm import language_model, quality
from tests.llm.conftest import ROWS, rows

TABLE = "/root/testdata/sf0.01"


def remainder(doc_id, modulus):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus


@pytest.fixture(scope="module")
def labelled(spark):
    docs, labels = (spark.read.parquet(f"{TABLE}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels


def test_chunks_cover_every_byte():
    for size in (0, 1, 511, 512, 513, 960, 961, 5000):
        data = bytes(i % 251 + 1 for i in range(size))
        text = data.decode("latin-1").encode("utf-8")
        block, sizes = quality.chunks(data.decode("latin-1"))
        seen = bytearray(len(text))
        for i, (row, n) in enumerate(zip(block, sizes, strict=True)):
            assert row[:n].tobytes() == text[i * quality.STEP : i * quality.STEP + n]
            seen[i * quality.STEP : i * quality.STEP + n] = b"\1" * n
        assert all(seen)


def test_gradients():
    rng = np.random.default_rng(0)
    net = quality.Network.fresh()
    for name in net.names[:4]:
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.weight = rng.normal(0, 0.1, len(net.weight))
    block = rng.integers(0, 256, (3, quality.CHUNK)).astype(np.uint8)
    sizes, label = np.array([quality.CHUNK, 100, 9]), np.array([0.0, 1.0, 1.0])

    def loss():
        logit = net.features(net.convolve(block, sizes), sizes) @ net.weight
        return (np.logaddexp(0, logit) - label * logit).mean() + 0.5e-4 * (net.weight**2).sum()

    grads = {}

    def spy(state, name, value, grad):
        grads[name] = grad
        return value

    original, quality._adam = quality._adam, spy
    try:
        quality._step(net, {}, block, sizes, label)
    finally:
        quality._adam = original
    for name, grad in grads.items():
        value = getattr(net, name)
        for at in rng.integers(0, value.size, 6):
            place = np.unravel_index(at, value.shape)
            before, eps = value[place], 1e-5
            value[place] = before + eps
            up = loss()
            value[place] = before - eps
            down = loss()
            value[place] = before
            assert grad[place] == pytest.approx((up - down) / (2 * eps), abs=2e-4)


def test_quality_scores(labelled):
    docs, labels = labelled
    scored = {r.doc_id: r for r in quality.quality_scores(docs, labels).collect()}
    assert len(scored) == docs.count()
    marks = {r.doc_id: r.quality for r in labels.collect()}
    held = [i for i in marks if remainder(i, 4) == 2]
    assert {i for i, r in scored.items() if r.held_out} == {i for i in scored if remainder(i, 4) == 2}
    assert np.mean([scored[i].predicted == marks[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scored.values())


def test_held_out_labels_change_nothing(labelled):
    docs, labels = labelled
    other = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality"
    )
    first, second = quality.train(docs, labels, 40), quality.train(docs, other, 40)
    for name in first.names:
        assert np.array_equal(getattr(first, name), getattr(second, name))


def test_quality_of_odd_rows(docs, no_docs, labelled, spark):
    labels = spark.createDataFrame([(1, 1), (3, 0), (6, None), (None, 1), (4, 0), (7, 5)], "doc_id long, quality int")
    assert quality.quality_scores(docs, labels).count() == len(ROWS)
    assert quality.quality_scores(no_docs, labels).count() == 0
    none = quality.quality_scores(docs, labels.limit(0))
    assert {r.score for r in none.collect()} == {0.5}
    assert quality.drop_low_quality(docs, labels).columns == docs.columns


def plain_scores(training, items):
    counts = Counter()
    for _, text in training:
        counts.update(language_model.words(text))
    total = sum(counts.values())
    mass = total + 0.1 * (len(counts) + 1)
    out = []
    for i, text in items:
        found = language_model.words(text)
        base = sum(math.log10((counts[w] + 0.1) / mass) for w in found)
        out.append((i, len(found), sum(counts[w] > 0 for w in found), total, round(base, 6)))
    return sorted(out, key=repr)


def scored(df):
    columns = ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score")
    return sorted([(*r[:4], round(r[4], 6)) for r in rows(df, *columns)], key=repr)


@pytest.mark.parametrize("head", [3, 1 << 17])
def test_language_model_on_odd_rows(docs, no_docs, monkeypatch, head):
    monkeypatch.setattr(language_model, "HEAD", head)
    items = [r[:2] for r in ROWS]
    training = [r for r in items if r[0] is None or r[0] > 3]
    texts = docs.filter("doc_id > 3 or doc_id is null")
    assert scored(language_model.model_scores(docs, texts)) == plain_scores(training, items)
    assert language_model.model_scores(no_docs, texts).count() == 0
    assert scored(language_model.model_scores(docs, no_docs)) == plain_scores([], items)


def test_language_model_beats_the_base(spark):
    found = language_model.op9_language_model(spark, TABLE).collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in found if remainder(r.doc_id, 10) == 0}
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_add_up():
    head = [(b"w%d" % i, 1000 // (i + 1) + 1) for i in range(400)] + [(language_model.END, 7)]
    total = sum(c for _, c in head) + 90
    known = language_model.Vocabulary(head, total, 441)
    rng = np.random.default_rng(0)
    contexts = rng.integers(0, language_model.CLASSES**2, 500)
    model = language_model.fit(contexts, rng.integers(0, 128, 500), rng.integers(1, 9, 500), known.used)
    table = 10 ** model.log_probabilities().astype(np.float64)
    assert np.allclose(table.sum(1), 1, atol=1e-4)
    # Shares of the words of each class, the tail with its unknown word included.
    share = 10 ** known.share
    sums = np.bincount(known.classes[:-1], share[:-1], language_model.CLASSES)
    sums[language_model._TAIL] += share[-1] * (90 + 0.1 * (40 + 1))
    assert np.allclose(sums[known.used], 1)
    assert np.allclose(table[:, ~known.used].sum(), 0, atol=1e-3)
