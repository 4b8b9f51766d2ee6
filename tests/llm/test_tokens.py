"""Token counts and piece ids against the libraries."""

import itertools
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortline.llm import pieces, token_counts
from tests.llm.conftest import ROWS, rows

ODD = [
    "'s", "'re", "'ll", "'t", "'", "  ", " ", "\n", "\t", "a", "B", "9", "é", "日", "本", "☃", "!", "he", "in",
    "<|endoftext|>", " ", "　", "\U0001f600", "don't", "\x1c", "\u0085", "²", "ª", "́", "\x00",
    "<s>", "<0x41>", "the", "tion", "==", "----",
]


def odd_texts(n, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 40))) for _ in range(n)]
    return texts + ["a" * 3000, " " * 3000, "ab" * 900, "'" * 400, "é" * 500, ""]


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(public_tokenizers.path(token_counts.VOCABULARY))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))


def lengths(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_library(counter, library, given):
    texts = odd_texts(4000, 1) + [t for _, t in given]
    assert counter.counts(texts).tolist() == lengths(library, texts)


def test_every_character_class(counter, library):
    texts = [f"a{chr(c)}1{chr(c)}!{chr(c)} " for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    assert counter.counts(texts).tolist() == lengths(library, texts)


def test_few_states_and_small_slices(library, monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE", 300)
    own = token_counts.Counter(public_tokenizers.path(token_counts.VOCABULARY))
    own.merger.limit = 50
    texts = odd_texts(150, 2) + [" ".join(f"w{i}x" for i in range(400))]
    assert own.counts(texts).tolist() == lengths(library, texts)


def test_state_maps_compose(counter):
    rng = np.random.default_rng(0)
    splitter = counter.splitter
    symbols = rng.integers(0, 8, 200)
    one = 0
    for s in symbols:
        one = splitter.act[one, s]
    halves = []
    for part in (symbols[:90], symbols[90:]):
        element = 0
        for s in part:
            element = splitter.act[element, s]
        halves.append(element)
    assert splitter.compose[halves[0], halves[1]] == one


def test_token_count_rows(docs, no_docs, library):
    ours = token_counts.token_counts(docs, limit=5)
    texts = [t or "" for _, t, _ in ROWS]
    want = [(i, len(t.encode()), n, n > 5) for (i, _, _), t, n in zip(ROWS, texts, lengths(library, texts), strict=True)]
    assert rows(ours, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)
    assert token_counts.token_counts(no_docs).count() == 0


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder.load(public_tokenizers.path(pieces.MODEL))


def test_ids_equal_the_library(encoder, given):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    texts = odd_texts(1500, 3) + [t for _, t in given[:80]]
    ids = [encoder.encode(t).tolist() for t in texts]
    assert ids == library.encode(texts)
    assert [encoder.decode(i) for i in ids] == texts
    assert encoder.decode([1, 5, 2]) == library.decode([1, 5, 2])


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 20])
def test_any_chunks_give_the_same_path(encoder, chunk):
    for text in odd_texts(60, 4)[:60] + ["=" * 90 + "ab" * 50]:
        text = text.replace(" ", pieces.BLANK)
        assert encoder.path(text, chunk) == encoder.path(text, 1 << 30)


@pytest.mark.parametrize("chunk", [1, 2, 3, 100])
def test_unigram_scores_against_all_segmentations(chunk):
    rng = random.Random(5)
    alphabet = "ab"
    names = ["".join(p) for n in (1, 2, 3) for p in itertools.product(alphabet, repeat=n)]
    scores = {p: (i, -rng.random() * 5) for i, p in enumerate(names) if p != "b"}
    own = pieces.Encoder(scores, list(range(1000, 1256)), bpe=False)
    for _ in range(40):
        text = "".join(rng.choices(alphabet, k=rng.randint(1, 9)))
        best = None
        for cuts in itertools.product([0, 1], repeat=len(text) - 1):
            parts, start = [], 0
            for i, c in enumerate([*cuts, 1], 1):
                if c:
                    parts.append(text[start:i])
                    start = i
            if all(p in scores or len(p) == 1 for p in parts):
                value = sum(scores[p][1] if p in scores else own.unknown for p in parts)
                best = max(best, value) if best is not None else value
        path = own.path(text, chunk)
        assert "".join(path) == text
        assert sum(scores[p][1] if p in scores else own.unknown for p in path) == pytest.approx(best)


def test_small_stores_give_the_same_ids(encoder, monkeypatch):
    texts = odd_texts(200, 8) + [" ".join(f"word{i % 301} x{i}" for i in range(120_000))]
    assert len(texts[-1]) > 1 << 20
    want = [encoder.encode(t).tolist() for t in texts]
    monkeypatch.setattr(pieces, "KEPT_BYTES", 20_000)
    monkeypatch.setattr(pieces, "PAIR_BYTES", 30_000)
    own = pieces.Encoder.load(public_tokenizers.path(pieces.MODEL))
    assert [own.encode(t).tolist() for t in texts] == want
    assert own.bytes < 20_000 and own.pairs < 40_000


def test_prefix_scan_is_associative():
    rng = np.random.default_rng(1)
    matrices = [rng.normal(size=s) for s in ((1, 4), (4, 3), (3, 5), (5, 2), (2, 2))]
    total = matrices[0]
    for got, m in zip(pieces.prefix_scan(matrices)[1:], matrices[1:], strict=True):
        total = pieces.max_plus(total, m)
        assert np.allclose(got, total)


def test_encoded_rows(docs, no_docs, encoder):
    ours = pieces.encode_documents(docs.withColumn("n_pieces", F.lit("clash")))
    want = [(i, encoder.encode(t).tolist(), len(encoder.encode(t)), True) for i, t, _ in ROWS]
    assert rows(ours, "doc_id", "piece_ids", "n_pieces", "round_trip") == sorted(want, key=repr)
    assert pieces.encode_documents(no_docs).count() == 0


def test_verdicts_of_pairs_are_kept_and_blank_marks_are_cut_alike(encoder, monkeypatch):
    monkeypatch.setattr(pieces, "PAIR_BYTES", 200_000)
    own = pieces.Encoder(encoder.scores, encoder.byte_ids)
    words = ["the", "of", "and", "in", "to", "that", "was", "for", "with", "his"]
    told = [f"{a}{b}{c}" for a in words for b in words for c in words[:4]]
    own.encode(" ".join(told))
    # At 390 bytes a pair the store was emptied every 512 of them.
    assert sum(map(len, own.apart.values())) > 600 and own.pairs < 210_000
    for text in (" a  b ", "a b", "x, y  7z", " "):
        marked = text.replace(" ", pieces.BLANK)
        assert own.encode(text).tolist() == own.encode(marked).tolist()


def test_one_edge_ends_at_each_position(encoder, monkeypatch):
    words = ["▁internationalisation", "▁überraschung", "▁日本語x", "▁aaaaaaab", "ththeatiōn"]
    tried = []
    real = pieces.Encoder.weight
    monkeypatch.setattr(pieces.Encoder, "weight", lambda self, a, b: tried.append((a, b)) or real(self, a, b))
    # Steps that are forgotten all the time give the same edges.
    for room in (pieces.STEP_BYTES, 1):
        monkeypatch.setattr(pieces, "STEP_BYTES", room)
        own = pieces.Encoder(encoder.scores, encoder.byte_ids)
        for word in words:
            begins = own._begins(word, (0, 0), len(word))
            assert [word[b:e] for e, b in enumerate(begins) if e] == [encoder.merge(word[:e])[-1] for e in range(1, len(word) + 1)]
            assert own.path(word) == encoder.merge(word)
        assert own.steps < room + 2_000
    # Trying every piece from every position took 142 pairs.
    assert len(set(tried)) < 100
