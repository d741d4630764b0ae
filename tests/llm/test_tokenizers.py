import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskloom.llm.pieces import PieceModel, piece_digests, piece_ids
from riskloom.llm.tokens import MergeCounter, token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
mine, theirs = PieceModel(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
counter, tokenizer = MergeCounter(VOCABULARY), Tokenizer.from_file(VOCABULARY)

texts = st.text(st.sampled_from("aaabcetinoT▁ \n\t019é́😀梦ᄀ<s>/x_=-.,'!\x1c\x85\xa0İΣ"), max_size=40)


@settings(max_examples=400, deadline=None)
@given(texts)
def test_pieces_equal_the_library(text):
    ids = theirs.encode(text)
    assert mine.encode(text) == ids
    assert mine.decode(ids) == theirs.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(sorted(mine.rank)), max_size=5).map("".join))
def test_joined_pieces_equal_the_library(text):
    assert mine.encode(text) == theirs.encode(text)


def test_every_piece_of_a_pair_is_tested_as_merged():
    for a, b in [("▁th", "e"), ("a", "a"), ("in", "g"), ("▁", "▁")]:
        left, right = mine.id[a], mine.id[b]
        assert mine.compatible(left, right) == (mine._merge(a + b) == [a, b])


@settings(max_examples=400, deadline=None)
@given(texts | st.lists(st.sampled_from(["<|endoftext|>", "a", " ", "'s", "22", "the"])).map("".join))
def test_counts_equal_the_library(text):
    assert counter.counts([text]) == [len(tokenizer.encode(text, add_special_tokens=False).ids)]


def test_runs_of_one_symbol_merge_from_the_left():
    words = ["a" * n for n in range(1, 40)] + ["!" * n for n in range(1, 20)]
    expected = [len(tokenizer.encode(w, add_special_tokens=False).ids) for w in words]
    assert counter.merge_counts(words).tolist() == expected


def test_odd_texts(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"] or "") for r in odd_docs.select("doc_id", "text").collect()]
    digests = {(r["doc_id"], r["ids_sha256"], r["decoded_sha256"], r["n_tokens"]) for r in piece_digests(odd_docs, PIECES).collect()}

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    ids = [theirs.encode(t) for _, t in rows]
    assert digests == {
        (d, sha(",".join(map(str, i))), sha(theirs.decode(i)), len(i)) for (d, _), i in zip(rows, ids, strict=True)
    }
    assert sorted(len(r["ids"]) for r in piece_ids(odd_docs, PIECES).collect()) == sorted(map(len, ids))
    counted = token_counts(odd_docs, VOCABULARY, limit=50).collect()
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in counted) == sorted(
        (d or -1, len(t.encode()), n, n > 50)
        for (d, t), n in zip(rows, [len(e.ids) for e in tokenizer.encode_batch([t for _, t in rows], add_special_tokens=False)], strict=True)
    )
    assert piece_digests(no_docs, PIECES).count() == 0
    assert token_counts(no_docs, VOCABULARY).count() == 0


@pytest.mark.parametrize("limit", [1, 3])
def test_a_full_cache_starts_anew(limit, monkeypatch):
    monkeypatch.setattr("riskloom.llm.pieces.CACHED", limit)
    monkeypatch.setattr("riskloom.llm.tokens.CACHED_WORDS", limit)
    model, small = PieceModel(PIECES), MergeCounter(VOCABULARY)
    text = "the quick brown fox jumps over the lazy dog, again and again"
    for _ in range(2):
        assert model.encode(text) == theirs.encode(text)
        assert small.counts([text, text]) == [len(tokenizer.encode(text, add_special_tokens=False).ids)] * 2
