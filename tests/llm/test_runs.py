"""Periodic runs against a direct search, and the suffix array against sorting."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from cohortline.llm import runs as r
from tests.llm.conftest import ROWS, SF, rows


def plain_runs(words):
    """All runs by trying every period at every place."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            stretch = words[i : i + length]
            smaller = any(all(stretch[k] == stretch[k + p] for k in range(length - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda x: (x[0], x[2]))


def found(texts):
    number = {}
    ids = [number.setdefault(w, len(number)) for t in texts for w in t]
    return r.runs_of(np.array(ids, np.int64), np.array([len(t) for t in texts], np.int64))


def random_text(rng):
    kind = rng.randrange(4)
    if kind == 0:
        return [rng.choice("ab") for _ in range(rng.randrange(60))]
    if kind == 1:
        return [rng.choice("abc") for _ in range(rng.randrange(4))] * rng.randrange(20)
    if kind == 2:
        part = [rng.choice("abcd") for _ in range(rng.randrange(1, 6))]
        inner = (part * rng.randrange(1, 7))[: rng.randrange(1, 40)]
        return [rng.choice("ab") for _ in range(rng.randrange(5))] + inner * rng.randrange(1, 6) + ["x"] * rng.randrange(8)
    return ["a"] * rng.randrange(50)


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_direct_search(seed):
    rng = random.Random(seed)
    texts = [random_text(rng) for _ in range(300)]
    assert found(texts) == [plain_runs(t) for t in texts]


def test_few_look_ups_at_a_time(monkeypatch):
    monkeypatch.setattr(r, "_EXPANDED", 3)
    texts = [random_text(random.Random(9)) for _ in range(60)]
    assert found(texts) == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("seed", range(4))
def test_suffix_array(seed):
    rng = np.random.default_rng(seed)
    texts = [rng.integers(0, 1 + seed, rng.integers(0, 40)).tolist() for _ in range(12)]
    sizes = np.array([len(t) for t in texts], np.int64)
    words, first = np.array([w for t in texts for w in t], np.int64), np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(texts)), sizes)
    array = r.suffix_array(words, doc, (first + sizes)[doc])
    suffixes = [(d, t[i:], first[d] + i) for d, t in enumerate(texts) for i in range(len(t))]
    want = sorted(suffixes)
    assert array.order.tolist() == [at for *_, at in want]
    assert (array.rank[array.order] == np.arange(len(words))).all()
    for k in range(1, len(want)):
        (a, x, _), (b, y, _) = want[k - 1], want[k]
        same = next((i for i, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y)))
        assert array.common[k] == (same if a == b else -1)


def test_long_texts():
    many = ["a"] * 150_000
    assert found([many]) == [[(0, 150_000, 1)]]
    part = [str(i) for i in range(30_000)]
    assert found([["x", *part * 5, "y"]]) == [[(1, 150_000, 30_000)]]
    fibonacci, before = ["a", "b"], ["a"]
    while len(fibonacci) < 20_000:
        fibonacci, before = fibonacci + before, fibonacci
    assert found([fibonacci]) == [[]]  # no fourth power anywhere
    assert found([["a", "b"] * 40_000 + ["c"] + ["b", "a"] * 40_000])[0] == [(0, 80_000, 2), (80_001, 80_000, 2)]


def test_a_text_of_over_one_megabyte_through_spark(spark):
    text = "start " + "some words that come again " * 45_000 + "end"
    assert len(text) > 1 << 20
    row = r.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row["n_runs"], row["start"], row["length"], row["period"]) == (1, 1, 225_000, 5)
    assert row["collapsed"].decode() == "start some words that come again end"


def plain_result(doc, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(b"" if doc is None else str(doc).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = found([words])[0]
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_query_equals_brute_force(spark, given):
    ours = rows(r.op13_runs(spark, SF))
    assert ours == sorted([plain_result(*d) for d in given], key=repr)
    assert any(x[1] for x in ours)
    # The search of the small texts, planted ones among them, is checked directly too.
    short = [(d, t) for d, t in given if len(t or "") < 2500]
    for doc, text in short:
        words = (text or "").encode().split()
        words = [words[i] for i in r.planted(doc, len(words))]
        assert found([words])[0] == plain_runs(words)


def test_odd_rows(spark, docs, no_docs):
    ours = rows(r.periodic_runs(docs), "doc_id", "n_runs", "collapsed")
    assert len(ours) == len(ROWS)
    texts = {(d, " ".join((t or "").split(" ")).strip()) for d, t, _ in ROWS}
    assert (3, 0, bytearray()) in ours and (4, 0, bytearray()) in ours and (5, 0, bytearray()) in ours
    assert (9, 0, bytearray(b"one")) in ours and texts
    assert r.periodic_runs(no_docs).count() == 0
    planted = r.periodic_runs(docs, plant=True)
    assert planted.count() == len(ROWS)
