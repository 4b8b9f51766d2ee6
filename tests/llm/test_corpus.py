"""Decontamination, the queries against SQL, and the pipeline."""

import hashlib
import re
import time

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cohortline.llm import decontaminate, queries
from cohortline.llm.exact_dedup import exact_duplicates
from tests.llm.conftest import ROWS, SF, rows

NUMBERS = {int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES}


def test_contract():
    assert NUMBERS == set(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, name):
    ours = queries.QUERIES[name](spark, SF)
    theirs = duck.execute(queries.ORACLES[name])
    columns = [c[0] for c in theirs.description]
    assert sorted(columns) == sorted(ours.columns)
    assert rows(ours, *columns) == sorted(theirs.fetchall(), key=repr)


def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_contamination(documents, items, width=10):
    grams = {}
    for item, text in items:
        tokens = plain_words(text)
        size = min(len(tokens), width)
        for i in range(len(tokens) - size + 1 if size else 0):
            grams.setdefault(tuple(tokens[i : i + size]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in documents:
        tokens, hit, found = plain_words(text), set(), set()
        for size in {len(g) for g in grams}:
            for i in range(len(tokens) - size + 1):
                if owners := grams.get(tuple(tokens[i : i + size])):
                    hit |= set(range(i, i + size))
                    found |= owners
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(tokens), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def test_contamination_of_odd_rows(docs, no_docs, spark):
    items = [(1, "THE quick, brown fox jumps over the lazy dog tonight"), (2, "ÉTÉ"), (3, None), (4, "..."), (None, "one"),
             (5, "word5 of5 word6 of6 word7 of0 word8 of1 word9 of2 word10 of3 word11"), (6, "ONE"), (6, "ONE"), (10, "same id")]
    frame = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS hash", "2 AS gram")
    ours = decontaminate.contamination(docs, frame).drop("text_hash")
    assert rows(ours) == plain_contamination([r[:2] for r in ROWS], items)
    assert not any(r.contaminated for r in decontaminate.contamination(docs, frame.limit(0)).collect())
    assert decontaminate.contamination(no_docs, frame).count() == 0
    clean = decontaminate.drop_contaminated(docs, frame)
    assert clean.columns == docs.columns
    want = [w[0] for w in plain_contamination([r[:2] for r in ROWS], items) if not w[-1]]
    assert sorted((r.doc_id for r in clean.collect()), key=repr) == sorted(want, key=repr)


def test_pipeline_stages(spark):
    read = spark.read.parquet(f"{SF}/documents.parquet")
    docs, columns = read, read.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == columns, name
        assert kept.exceptAll(docs).count() == 0
        docs = spark.createDataFrame(kept.collect(), read.schema)
    assert 0 < docs.count() < read.count()
    assert exact_duplicates(docs).filter("not kept").count() == 0
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert not any(w[-1] for w in plain_contamination(texts, items))
    final = corpus_pipeline.run(spark, SF)
    assert rows(final, "doc_id") == rows(docs, "doc_id")
    assert final.filter("not round_trip or size(piece_ids) <> n_pieces").count() == 0


def test_long_texts_take_time_in_proportion(spark):
    """A text four times as long does not take sixteen times as long."""
    passage = " ".join(f"planted{i}" for i in range(12))
    benchmark = spark.createDataFrame([("b1", passage)], "item_id string, text string")

    def seconds(n):
        text = " ".join(f"w{i % 9973}" for i in range(n)) + " " + passage
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string").persist()
        docs.count()
        start = time.perf_counter()
        found = decontaminate.contamination(docs, benchmark).first()
        assert (found["n_words"], found["n_hit"], found["n_items"]) == (n + 12, 12, 1)
        return time.perf_counter() - start

    seconds(1000)
    short, long = seconds(100_000), seconds(400_000)
    assert len(" ".join(f"w{i % 9973}" for i in range(400_000))) > 1 << 21
    assert long < 8 * short + 5
