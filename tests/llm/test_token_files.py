"""Files of token ids: exact round trips, checksums, and the library's ids."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortline.llm import token_files as tf
from cohortline.sources.files import get_file, put_file
from tests.llm.conftest import ROWS, SF, rows
from tests.llm.test_tokens import odd_texts

PATH = public_tokenizers.path(tf.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def wanted(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def brute(library, docs):
    """``(doc_id, start, n_tokens, ids_crc32)`` of documents in their order."""
    out, start = [], 0
    for doc, ids in zip([d for d, _ in docs], wanted(library, [t or "" for _, t in docs])):
        data = np.array([*ids, tf.END], "<u4").tobytes()
        out.append((doc, start, len(ids) + 1, zlib.crc32(data)))
        start += len(ids) + 1
    return out


def table_of(ids):
    return tf.Table.of_counts(dict(zip(*[x.tolist() for x in np.unique(ids, return_counts=True)])))


def test_words_give_the_ids_of_texts(library, given):
    own = tf.Tokens(PATH)
    texts = odd_texts(3000, 3) + [t or "" for _, t in given] + ["<|endoftext|>" * 3, "a<|endoftext|> b", "<|endoftext"]
    assert own.by_words
    assert [x.tolist() for x in own.encode(texts)] == wanted(library, texts)


def test_long_texts_and_a_small_store_of_words(library, monkeypatch):
    monkeypatch.setattr(tf, "_SLICE", 500)
    monkeypatch.setattr(tf, "_KEPT_BYTES", 20_000)
    monkeypatch.setattr(tf, "_WORD_BYTES", 10)
    text = " ".join(f"word{i % 977} {i}," for i in range(150_000))
    assert len(text) > 1 << 20
    assert tf.Tokens(PATH).encode([text])[0].tolist() == wanted(library, [text])[0]


def test_words_under_one_hash(library, given, monkeypatch):
    monkeypatch.setattr(tf, "_powers", type("", (), {"__call__": lambda s, b: (np.zeros(1 << b, np.uint64),) * 2})())
    texts = [t or "" for _, t in given[:20]]
    assert [x.tolist() for x in tf.Tokens(PATH).encode(texts)] == wanted(library, texts)


def test_a_vocabulary_that_is_not_byte_level(library):
    path = public_tokenizers.path("word_bpe_49k.json")
    own, texts = tf.Tokens(path), ["Hello World  again", "", "Été"]
    assert not own.by_words
    assert [x.tolist() for x in own.encode(texts)] == wanted(Tokenizer.from_file(path), texts)


@pytest.mark.parametrize("n", [0, 1, tf.LANES - 1, tf.LANES, tf.LANES + 1, tf.STRIDE - 1, tf.STRIDE, tf.STRIDE + 1, 3 * tf.STRIDE + 700])
@pytest.mark.parametrize("kind", ["skewed", "one", "flat"])
def test_blocks_round_trip(n, kind):
    rng = np.random.default_rng(n)
    ids = {
        "skewed": (rng.pareto(0.7, n) * 5).clip(0, 60_000).astype(np.uint32),
        "one": np.full(n, 7, np.uint32),
        "flat": rng.integers(0, 50_000, n).astype(np.uint32),
    }[kind]
    shared = tf.Table.unpack(table_of(ids).pack())
    stream, states, before = tf.encode_block(ids, shared)
    assert len(states) == len(before) == -(-n // tf.STRIDE)
    assert (tf.decode_block(n, stream, states, before, shared) == ids).all()


def test_any_checkpoint_can_be_read_alone():
    rng = np.random.default_rng(1)
    ids = (rng.pareto(1, 4 * tf.STRIDE + 33) * 9).clip(0, 9000).astype(np.uint32)
    shared = table_of(ids)
    stream, states, before = tf.encode_block(ids, shared)
    for k in range(4):
        alone = tf.decode_block(tf.STRIDE, stream[before[k] :], states[k : k + 1], np.zeros(1, int), shared)
        assert (alone == ids[k * tf.STRIDE : (k + 1) * tf.STRIDE]).all()


def test_the_stream_is_near_the_entropy():
    ids = (np.random.default_rng(2).pareto(1, 1 << 20) * 9).clip(0, 9000).astype(np.uint32)
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    stream, states, _ = tf.encode_block(ids, table_of(ids))
    bits = 32 * len(stream) + 64 * states.size
    assert bits / len(ids) < -(share * np.log2(share)).sum() * 1.06


def test_unknown_ids_are_refused():
    with pytest.raises(ValueError, match="not in the frequency table"):
        tf.encode_block(np.array([5, 6], np.uint32), table_of(np.array([5], np.uint32)))
    with pytest.raises(ValueError, match="not in the frequency table"):
        tf.encode_block(np.array([4], np.uint32), table_of(np.array([5], np.uint32)))


def test_joined_checksums():
    data = np.random.default_rng(3).bytes(100_003)
    for cut in (0, 1, 4, 50_000, 100_003):
        first, second = data[:cut], data[cut:]
        assert tf.joined_crc(zlib.crc32(first), zlib.crc32(second), len(second)) == zlib.crc32(data)


def test_query_equals_brute_force(spark, library, given):
    assert rows(tf.op11_token_files(spark, SF)) == sorted(brute(library, sorted(given)), key=repr)


def written(spark, docs, tmp_path, **options):
    folder = f"{tmp_path}/ids"
    files = tf.write_token_files(docs, folder, **options)
    return folder, files


def test_documents_over_many_blocks(spark, library, tmp_path):
    texts = [(i, f"text {i} " * (1 + 400 * (i % 7 == 0))) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    folder, files = written(spark, docs, tmp_path, block=300)
    assert files.agg(F.max("blocks")).first()[0] > 3
    assert sorted(map(tuple, tf.read_checksums(spark, folder).collect())) == brute(library, texts)
    pieces = tf.read_token_files(spark, folder).orderBy("start").collect()
    assert [i for p in pieces for i in p["ids"]] == [
        i for ids in wanted(library, [t for _, t in texts]) for i in [*ids, tf.END]
    ]
    # Names in order give the ids in order.
    entries = tf.directory(spark, folder).orderBy("file", "block").collect()
    assert [(e["part"], e["block"]) for e in entries] == sorted((e["part"], e["block"]) for e in entries)


def test_odd_rows(spark, docs, library, tmp_path):
    folder, _ = written(spark, docs, tmp_path)
    found = sorted(map(tuple, tf.read_checksums(spark, folder).collect()), key=lambda r: r[1])
    assert len(found) == len(ROWS)
    ids = [r[0] for r in found]
    known = [i for i in ids if i is not None]
    assert known == sorted(known) and ids[len(known) :] == [None, None]
    assert [r[1] for r in found] == np.cumsum([0, *[r[2] for r in found[:-1]]]).tolist()
    parts = {(d, n, c) for d, _, n, c in brute(library, [(r[0], r[1]) for r in ROWS])}
    assert {(d, n, c) for d, _, n, c in found} == parts


def test_no_rows(spark, no_docs, tmp_path):
    folder, files = written(spark, no_docs, tmp_path)
    assert files.count() == 0
    assert tf.read_checksums(spark, folder).count() == 0


def test_damage_is_found(spark, tmp_path):
    texts = [(i, "some words to write down " * 50) for i in range(4)]
    folder, files = written(spark, spark.createDataFrame(texts, "doc_id long, text string"), tmp_path)
    name = files.first()["file"]
    data = bytearray(get_file(name))
    data[40] ^= 1
    put_file(name, [bytes(data)])
    with pytest.raises(Exception, match="is damaged"):
        tf.read_checksums(spark, folder).collect()


def test_new_words_are_told_apart_by_their_bytes(library, monkeypatch):
    words = [" the", "日本語", "é", "\n\n", " Été", "x" * 300, "\x00", " \U0001f600", "'s", "\u00ad\x7f"]
    own = tf.Tokens(PATH)
    # Words go to the library spelled, so that it neither cuts nor maps them nor keeps their offsets.
    assert own.by_words and own.library.pre_tokenizer is None
    own._learn(words)
    found = [own.ids[a : a + n].tolist() for a, n in zip(own.at, own.size[: len(words)])]
    assert found == [library.encode(w, add_special_tokens=False).ids for w in words]


def test_equal_words_are_found_where_hashes_meet(library):
    chars = np.frombuffer("ab ab a b ab".replace(" ", "").encode("utf-32-le"), np.uint32)
    first, same = tf._distinct(chars, np.array([0, 2, 4, 5, 6]), np.array([2, 2, 1, 1, 2]))
    assert first[same].tolist() == [0, 0, 2, 3, 0]
