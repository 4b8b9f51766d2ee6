"""Exact, near and passage deduplication against brute force."""

import hashlib
import itertools
import random
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from cohortline.llm import exact_dedup, graph, repeats, simhash
from cohortline.plans import durable
from tests.llm.conftest import ROWS, SF, rows


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_duplicates(docs):
    groups = {}
    for doc_id, text, _ in ROWS:
        groups.setdefault(normal(text), []).append(doc_id)
    want = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for i in ids:
            stays = i == keep and first
            first = first and not stays
            want.append((i, keep, len(ids), stays, digest))
    ours = exact_dedup.exact_duplicates(docs, digest=True)
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert rows(ours, *columns) == sorted(want, key=repr)
    plain = exact_dedup.exact_duplicates(docs)
    assert rows(plain, *columns[:4]) == sorted([w[:4] for w in want], key=repr)


def test_drop_exact_duplicates_keeps_columns(docs):
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    texts = [normal(t) for t, in rows(kept, "text")]
    assert len(texts) == len(set(texts)) == len({normal(t) for _, t, _ in ROWS})


def test_empty_tables(no_docs):
    assert exact_dedup.exact_duplicates(no_docs, digest=True).count() == 0
    assert exact_dedup.drop_exact_duplicates(no_docs).count() == 0
    assert simhash.simhash_groups(no_docs).count() == 0
    assert repeats.remove_repeats(no_docs).count() == 0


def plain_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    shingles = [words[i : i + width] for i in range(len(words) - width + 1)] or [words] * bool(words)
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_groups(points):
    parent = {p: p for p in points}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(points, 2):
        if (a ^ b).bit_count() <= 2:
            parent[find(a)] = find(b)
    return {p: find(p) for p in points}


def test_simhash_groups(docs):
    prints = [(i, plain_fingerprint(t)) for i, t, _ in ROWS]
    root = plain_groups({p for _, p in prints})
    want = []
    for i, p in prints:
        ids = [j for j, q in prints if root[q] == root[p] and j is not None]
        want.append((i, f"{p:016x}", min(ids, default=None)))
    assert rows(simhash.simhash_groups(docs), "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)
    kept = rows(simhash.drop_near_duplicates(docs), "doc_id")
    assert {i for i, in kept} == {c for _, _, c in want}


def test_fingerprints_of_given_texts(given):
    for _, text in given[:60]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_near_links_find_every_component(spark, bits):
    rng = random.Random(bits)
    points = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        # Crowds around a centre, chains away from it, and points just too far.
        points |= {centre ^ 1 << rng.randrange(64) for _ in range(40)} | {centre}
        for _ in range(25):
            centre ^= sum(1 << b for b in rng.sample(range(64), rng.randint(bits, bits + 1)))
            points.add(centre)
    signed = [int(np.uint64(p).astype(np.int64)) for p in points]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp long"), bits)
    roots = dict(graph.components(links).collect())
    parent = {p: p for p in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(signed, 2):
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= bits:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    assert {p: roots.get(p, p) for p in signed} == {p: find(p) for p in signed}


def test_components_of_long_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1400)] + [(7, 7)]
    roots = dict(graph.components(spark.createDataFrame(links, "u long, v long")).collect())
    assert roots == {i: 0 for i in range(201)} | {i: 1000 for i in range(1000, 1400)}


def plain_repeats(items, length=50):
    first, out = {}, []
    last = (1 << 63) - 1
    coded = [(last if i is None else i, i, (t or "").encode()) for i, t in items]
    for key, _, data in coded:
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            first[s] = min(first.get(s, key), key)
    for key, i, data in coded:
        gone = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - length + 1):
            if first[data[p : p + length]] < key:
                gone[p : p + length] = True
        gone = gone[:-1]
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((i, len(data), int(gone.sum()), spans, kept))
    return sorted(out, key=repr)


def shown(df):
    return sorted(
        [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()], key=repr
    )


def test_repeats(docs, given, spark):
    assert shown(repeats.remove_repeats(docs)) == plain_repeats([(i, t) for i, t, _ in ROWS])
    small = spark.read.parquet(f"{SF}/documents.parquet")
    assert shown(repeats.remove_repeats(small)) == plain_repeats(given)


def test_repeats_with_hot_triggers_and_small_slices(spark, monkeypatch):
    rng = random.Random(3)
    passage = "".join(rng.choices("abcdefgh ", k=140))
    items = []
    for i in range(60):
        filler = ["".join(rng.choices("abcdefgh ", k=rng.randint(0, 90))) for _ in range(2)]
        cut = sorted(rng.sample(range(141), 2))
        items.append((i, filler[0] + passage[cut[0] : cut[1]] + filler[1] + "é" * rng.randint(0, 60)))
    items += [(60, "z" * 500), (61, "z" * 70), (62, passage * 4)]
    frame = spark.createDataFrame(items, "doc_id long, text string")
    assert shown(repeats.remove_repeats(frame)) == plain_repeats(items)
    # Every trigger is hot, and texts are cut into many pieces.
    monkeypatch.setattr(repeats, "HOT_SHARE", 0.001)
    texts = repeats._keyed(frame)
    _, hot = repeats.repeated_phrases(texts)
    assert hot
    assert shown(repeats.remove_repeats(frame)) == plain_repeats(items)
    monkeypatch.setattr(repeats, "_SLICE", 64)
    pieces = repeats._pieces(items[60][1].encode())
    assert len(pieces) > 5
    phrases = np.concatenate([repeats.Parse([p]).phrase for p in pieces]).view(np.int64)
    part = pa.RecordBatch.from_pydict({"text": [items[60][1], "x" * 60, None]})
    none = np.empty(0, np.int64)
    masks = repeats._removed(part, [phrases, none, none], [none, none, none])
    assert set(masks) == {0} and masks[0].all() and len(masks[0]) == 500


def test_later_rows_of_one_hot_key_without_a_join(spark):
    rng = random.Random(1)
    told = [(1, 1, rng.randrange(3000)) for _ in range(6000)] + [(rng.randrange(9), rng.randrange(9), rng.randrange(40)) for _ in range(3000)]
    frame = spark.createDataFrame([*told, (-5, 3, 7)], "trigger long, phrase long, doc long").repartition(7)
    least = {}
    for t, p, d in [*told, (-5, 3, 7)]:
        least[t, p] = min(d, least.get((t, p), d))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = repeats.later_rows(frame, ["trigger", "phrase"])
        got = found.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(got) == 9001 and all(r.later == (r.doc > least[r.trigger, r.phrase]) for r in got)
    assert "Join" not in found._jdf.queryExecution().toString()


def test_hot_triggers_are_all_found_and_no_rare_ones(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_SHARE", 1 / 50)
    passage = "This very passage of some words stands in each and every text of all of them here. "
    rng = random.Random(2)
    texts = [passage + "".join(rng.choice("abcdefgh ") for _ in range(150)) for _ in range(400)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc long, text string").repartition(5)
    rows = repeats.parse(frame).groupBy("trigger").count().collect()
    every = sum(r["count"] for r in rows)
    hot = set(repeats.hot_triggers(frame))
    assert {r.trigger for r in rows if r["count"] >= every / 50} <= hot
    assert hot and all(r["count"] >= every / 100 for r in rows if r.trigger in hot)


def test_repeats_hold_few_bytes_on_disk(spark):
    rng = random.Random(4)
    base, texts = rng.choices("abcdefgh ", k=20_000), []
    for _ in range(30):
        text = list(base)
        for place in rng.sample(range(len(text)), 200):
            text[place] = "X"
        texts.append("".join(text))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc long, text string")
    with durable.own_tables(spark):
        found, hot = repeats.repeated_phrases(frame)
        repeats.repeated_stretches(frame, found.filter("not whole"), hot).collect()
        job = spark.sparkContext.getLocalProperty(durable._JOB)
        held = sum(p.stat().st_size for p in Path(durable.shared_folder(spark), "cohortline", job).rglob("*.parquet"))
    # The hashes of all stretches of shared phrases are not among what stays until the end.
    assert held < 3 * sum(map(len, texts))


def test_stretches_of_a_trigger_are_compared_together(monkeypatch):
    rng = random.Random(5)
    rows = [(rng.randrange(6), rng.randrange(9), "".join(rng.choices("ab", k=3)) * rng.randint(20, 60)) for _ in range(300)]
    rows.sort(key=lambda r: r[0])
    least = {}
    stretches = lambda b: [b[i : i + 50] for i in range(len(b) - 49)]
    for t, d, b in rows:
        for s in stretches(b):
            least[t, s] = min(d, least.get((t, s), d))
    hashed = lambda s: int(repeats._stretches(np.frombuffer(s.encode(), np.uint8), np.array([50]))[0][0])
    want = {(d, hashed(s)) for t, d, b in rows for s in stretches(b) if d > least[t, s]}
    schema = pa.schema([("trigger", pa.int64()), ("doc", pa.int64()), ("body", pa.binary())])
    parts = [
        pa.RecordBatch.from_pylist([{"trigger": t, "doc": d, "body": b.encode()} for t, d, b in rows[i : i + 7]], schema)
        for i in range(0, 300, 7)
    ]
    for compared in (1 << 22, 50):
        monkeypatch.setattr(repeats, "_COMPARED", compared)
        groups = list(repeats._by_trigger(iter(parts)))
        triggers = [{t for p in g for t in p["trigger"].to_pylist()} for g in groups]
        assert sum(map(len, triggers)) == 6 and sum(p.num_rows for g in groups for p in g) == 300
        got = [p for g in groups for p in repeats._later_stretches(g)]
        assert {(r["doc"], r["stretch"]) for p in got for r in p.to_pylist()} == want
