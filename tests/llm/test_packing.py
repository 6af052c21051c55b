"""Packing: ids equal the tokenizer's, every id in one piece, no gaps, the mixture in every window."""
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from barloom.llm import packing
from barloom.llm.common import staged

TOKENIZER = Tokenizer.from_file(packing.tokenizer_path())


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(exclude_categories=("Cs",)), st.sampled_from(list(" \n\t.,'éÉßÀİσΣſ́abcTHE0129ｅ­ªµ")))), max_size=5))
def test_ids_are_those_of_the_whole_text(texts):
    got = packing.encoder(packing.tokenizer_path())(texts)
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [ids(t) for t in texts]


def test_words_with_punctuation_behind_need_no_whole_tokenizer():
    """Ids are the tokenizer's; only the runs of punctuation, and pieces that are no word, go through all of it."""
    encode, seen = packing.WordEncoder(packing.tokenizer_path()), []
    words = [w + m for w in ("Elle", "\u00c9t\u00e9", "it", "we") for m in ("", ".", "***", "&&&", "'", "';", "|>", ".%%%")] + ["it's", "we're!", "<|endoftext|>", "a-b,", "7!!"]

    class Whole:
        def encode_batch_fast(self, some, add_special_tokens):
            seen.extend(some)
            return TOKENIZER.encode_batch_fast(some, add_special_tokens=add_special_tokens)

        def encode(self, text, add_special_tokens):
            return TOKENIZER.encode(text, add_special_tokens=add_special_tokens)
    encode.tokenizer = Whole()
    got = encode([" ".join(words), *words])
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [ids(t) for t in [" ".join(words), *words]]
    assert sorted(seen) == sorted(["it's", "we're!", "<|endoftext|>", "a-b,", "7!!"])


def packed(spark, rows, **sizes):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    tokens = staged(packing.tokenized(docs, packing.tokenizer_path()))
    return packing.pack(tokens, **sizes).toPandas()


def check_pieces(pieces, rows, length):
    for (d, text, _) in rows:
        own = pieces[pieces.doc_id.isna()] if d is None else pieces[pieces.doc_id == d]
        whole, at = np.array(ids(text) + [2], "<u4"), 0
        for r in own.sort_values("start").itertuples():
            assert r.start == at and r.doc_tokens == len(whole)
            assert zlib.crc32(whole[at:at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(whole)
    for _, s in pieces.sort_values("offset").groupby("sequence_id"):
        assert (s.length.cumsum() - s.length).tolist() == s.offset.tolist()
        n = int(s.length.sum())
        assert n == s.sequence_length.iloc[0] and (n == length or n & (n - 1) == 0)


def test_pieces_sequences_and_mixture(spark):
    rng = np.random.default_rng(1)
    words = ["alpha", "beta", "gamma", "delta,", "Überraschung", "x1", "!!"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 400))), "abc"[min(2, i % 5)]) for i in range(200)] + [(1000, None, None), (1001, "", "a"), (1002, "beta " * 5000, "b")]
    pieces = packed(spark, rows, length=64, window_sequences=4)
    check_pieces(pieces, rows, 64)
    total = int(pieces.length.sum())
    full = pieces.assign(at=pieces.sequence_id * 64 + pieces.offset)[lambda p: p.sequence_length == 64]
    shares = pieces.fillna({"source": "~"}).groupby("source").length.sum() / total
    for _, w in full.fillna({"source": "~"}).groupby(full["at"] // (64 * 8)):
        for s, share in shares.items():  # eight sequences hold at least one whole window
            assert abs(w.loc[w.source == s, "length"].sum() - share * w.length.sum()) < 200


def test_small_and_odd_tables(spark):
    assert packed(spark, []).empty
    rows = [(1, "one", "a")]
    check_pieces(packed(spark, rows), rows, 4096)
    same = packed(spark, [(7, "twice the same", "a"), (7, "twice the same", "a")])
    assert same.length.sum() == 2 * len(ids("twice the same") + [2])


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "one two", "a", 5, 6)], "doc_id long, text string, source string, part int, ids int")
    assert packing.pack(staged(packing.tokenized(docs, packing.tokenizer_path()))).count() >= 1


def test_more_sources_than_queues(spark, monkeypatch):
    rows = [(i, "alpha beta " * (1 + i % 7), None if i % 41 == 0 else f"host{i % 41}") for i in range(160)]
    own = packed(spark, rows, length=64, window_sequences=2)
    monkeypatch.setattr(packing, "MAX_SOURCES", 9)
    monkeypatch.setattr(packing, "POOLS", 4)
    monkeypatch.setattr(packing, "BASE_BYTES", 200)
    pooled = packed(spark, rows, length=64, window_sequences=2)
    for pieces in (own, pooled):
        check_pieces(pieces, rows, 64)
    assert pooled.length.sum() == own.length.sum() and pooled.source.nunique() == 40
