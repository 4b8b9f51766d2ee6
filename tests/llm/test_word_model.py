"""The language model tells words of one class apart, and its words add up to one."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cohortline.llm import language_model


def fresh(head, rare=90):
    known = language_model.Vocabulary(head, sum(c for _, c in head) + rare, len(head) + 40)
    classes = language_model.LogBilinear(np.where(known.used, 1.0, 1e-12) / known.used.sum())
    return known, language_model.WordModel(known, classes)


@pytest.mark.xfail(reason="open: one pass over these texts leaves 0.03 only", strict=False)
def test_every_word_has_its_own_vectors(spark):
    # Behind x always comes a, behind y always b; all four are too rare for a class of their own and share one.
    single, others = (" ".join(f"{k}{i}" for i in range(n)) for k, n in (("w", 94), ("v", 300)))
    texts = [single] * 3500 + [others] * 1500 + ["p x a q", "p y b q"] * 3000
    random.Random(0).shuffle(texts)
    training = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(2)
    docs = spark.createDataFrame([(1, "p x a q"), (2, "p x b q"), (3, "p y b q"), (4, "p y a q")], "doc_id long, text string")
    score = {r.doc_id: r.score for r in language_model.model_scores(docs, training).collect()}
    # Words that share all they have, as those of one class did, leave nothing here.
    assert score[1] - score[2] + score[3] - score[4] > 0.1, score


def test_words_add_up():
    head = [(b"w%d" % i, 1000 // (i + 1) + 1) for i in range(2000)] + [(language_model.END, 7)]
    known, model = fresh(head)
    rng = np.random.default_rng(0)
    learner = language_model.Learner(model)
    learner.learn(*rng.integers(0, len(head), (3, 9000)))
    for name in model.names:
        setattr(model, name, learner.own[name])
    every = np.arange(len(head) + 1)
    for earlier, before in ((5, 1700), (len(head), 3), (len(head) + 1, len(head) + 1)):
        found = model.log_probabilities(every, np.full_like(every, earlier), np.full_like(every, before))
        assert np.isclose((10**found).sum(), 1, atol=1e-4)


def test_changes_are_averaged_by_their_times():
    _, model = fresh([(b"w%d" % i, 9) for i in range(300)])
    one, two = (language_model.Learner(model, s) for s in (1, 2))
    one.learn(*np.random.default_rng(1).integers(0, 300, (3, 5000)))
    two.learn(*np.random.default_rng(2).integers(0, 300, (3, 900)))
    for batch in language_model._averaged(b for x in (one, two) for b in x.changes()):
        (r,) = batch.to_pylist()
        rows, times, moved = language_model._unpacked(r["name"], r["rows"], r["times"], r["moved"])
        counts = np.stack([x.times[r["name"]][r["block"] + rows] for x in (one, two)])
        change = np.stack([(x.own[r["name"]] - getattr(model, r["name"]))[r["block"] + rows] for x in (one, two)])
        assert np.array_equal(times, counts.sum(0))
        assert np.allclose(moved, (counts[..., None] * change).sum(0) / times[:, None], atol=1e-5)


def test_what_tasks_hand_on_is_bounded_by_the_tokens(spark, monkeypatch):
    texts = spark.createDataFrame([("a b",)] * 64, "text string").repartition(16)
    assert language_model.dealt(texts, 192).rdd.getNumPartitions() == 1
    monkeypatch.setattr(language_model, "_SHARE", 50)
    few = language_model.dealt(texts, 192)
    assert few.rdd.getNumPartitions() == 4 and few.count() == 64


def test_few_words_are_held_and_blocks_stay_the_same(monkeypatch):
    known, model = fresh([(b"w%d" % i, 100 - i) for i in range(60)] + [(language_model.END, 9)], 5)
    texts = [" ".join(f"w{(i * j) % 70}" for j in range(i % 23)) for i in range(200)]
    part = pa.RecordBatch.from_pydict({"text": texts})
    held = []
    real = language_model.Vocabulary.look_up
    monkeypatch.setattr(language_model.Vocabulary, "look_up", lambda self, w: held.append(len(w)) or real(self, w))
    monkeypatch.setattr(language_model, "_LEARNT", 900)
    whole = list(language_model._numbered(part, known))
    monkeypatch.setattr(language_model, "_WORDS", 40)
    held.clear()
    found = list(language_model._numbered(part, known))
    # Words of at most one more text than the bound; before, those of a whole block.
    assert max(held) < 40 + 23 and len(found) == len(whole) > 2
    assert all((a == c).all() and (b == d).all() for (a, b), (c, d) in zip(found, whole))
    starts, index = found[0]
    contexts = model.contexts(index, starts)
    logs = model.log_probabilities(index, *contexts)
    # Scores are made a few rows at a time, and do not depend on how many, nor on the shift.
    monkeypatch.setattr(language_model, "_ROWS", 3)
    monkeypatch.setattr(language_model, "_SAFE", 0.0)
    assert np.allclose(model.log_probabilities(index, *contexts), logs, atol=1e-5)


ODD = [None, "", " \t\n", "a", " A b\x0bC\x0c", "x\x1cy \xa0 z", "É é\r\n\nÄ", "end ", None, "a a a q q"]


@pytest.mark.parametrize("most", [1, 7, 1 << 20])
def test_words_of_all_texts_in_one_array(monkeypatch, most):
    monkeypatch.setattr(language_model, "_WORDS", most)
    texts = pa.array(["cut off", *ODD, "cut off"]).slice(1, len(ODD))
    found = list(language_model._split(texts))
    assert [b[0] for b in found] == [0, *(b[1] for b in found[:-1])] and found[-1][1] == len(ODD)
    plain = [language_model.words(t) for t in ODD]
    assert [n for b in found for n in b[2]] == list(map(len, plain))
    assert [w for b in found for w in b[3].to_pylist()] == [w for p in plain for w in p]


def test_scores_are_made_for_more_words_than_are_held_as_bytes(monkeypatch):
    known, model = fresh([(b"w%d" % i, 100 - i) for i in range(60)] + [(language_model.END, 9)], 5)
    texts = ODD + [" ".join(f"w{(i * j) % 70}" for j in range(i % 23)) for i in range(200)]
    monkeypatch.setattr(language_model, "_WORDS", 40)
    monkeypatch.setattr(language_model, "_SCORED", 900)
    row, sizes = 0, []
    for first, last, lengths, index, rare, times in language_model._blocks(pa.array(texts), known):
        assert first == row
        row = last
        plain = [language_model.words(t) for t in texts[first:last]]
        assert lengths.tolist() == list(map(len, plain))
        assert index.tolist() == known.look_up(pa.array([w for p in plain for w in p])).tolist()
        heads = set(known.head.to_pylist())
        expected = [Counter(w for w in p if w not in heads) for p in plain]
        assert [dict(zip(*x)) for x in zip(rare.to_pylist(), times.to_pylist())] == expected
        sizes.append(len(index))
    # Before, scores were made for the words held as bytes only, so that few pairs of words met.
    assert row == len(texts) and min(sizes[:-1]) >= 675


def test_counts_of_words_in_parts(spark, monkeypatch):
    monkeypatch.setattr(language_model, "_HELD", 3)
    monkeypatch.setattr(language_model, "_WORDS", 4)
    texts = spark.createDataFrame([(t,) for t in ODD * 3], "text string").coalesce(1)
    expected = Counter(w for t in ODD * 3 for w in language_model.words(t))
    assert {bytes(r.word): r.c for r in language_model.word_counts(texts).collect()} == expected
