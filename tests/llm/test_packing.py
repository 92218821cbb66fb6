import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from clickweave.llm import best_fit as b
from llm_help import no_docs, odd_docs  # noqa: F401

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)
ENCODE = b.Encoder(PATH)


def ids_of(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids + [0]


def check(docs, tokens):
    got = b.pack(docs, PATH, tokens=tokens, keep_ids=True).toPandas()
    want = sorted(tuple(ids_of(r.text)) for r in docs.collect())
    assert (got["length"] <= tokens).all()
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s["offset"].tolist() == (s["length"].cumsum() - s["length"]).tolist() and s["length"].sum() <= tokens
    for r in got.itertuples():
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    total = sum(map(len, want))
    assert got["length"].sum() == total
    return got, want


def test_odd_rows(odd_docs):
    got, want = check(odd_docs, 64)
    named = got[got["doc_id"].isin([1, 2, 4, 5, 6, 8, 9, 10])].sort_values("piece")
    back = {n: np.frombuffer(b"".join(g["ids"]), "<u4").tolist() for n, g in named.groupby("doc_id")}
    for r in odd_docs.where("doc_id IN (1, 2, 4, 5, 6, 8, 9, 10)").collect():
        assert back[r.doc_id] == ids_of(r.text)
    long = named[named["doc_id"] == 5]
    assert (long["length"].iloc[1:] == 64).all() and long["start"].tolist() == (long["length"].cumsum() - long["length"]).tolist()


def test_sequences_hold_the_ids(odd_docs):
    packed = b.pack(odd_docs, PATH, tokens=64, keep_ids=True)
    assert sum(len(r.ids) // 4 for r in b.sequences(packed).collect()) == sum(len(ids_of(r.text)) for r in odd_docs.collect())


def test_empty_table(no_docs):
    assert b.pack(no_docs, PATH).collect() == []


def test_few_sequences(spark, small):
    got, want = check(spark.read.parquet(f"{small}/documents.parquet"), 2048)
    assert got["sequence_id"].nunique() <= 1.02 * -(-sum(map(len, want)) // 2048)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"ab1é \n\t'!<|>中\u0085\u00a0", "  ", "the", "<|endoftext|>", "'s", " a"]), max_size=30).map("".join))
def test_parts_between_blanks_give_the_same_ids(text):
    assert ENCODE.merge  # the fast way is on
    assert np.frombuffer(ENCODE(text), "<u4").tolist() == WHOLE.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=80), st.sampled_from(["norm", "dot"]), st.sampled_from([3, 10, float("inf")]), st.sampled_from([10_000, 20_000, float("inf")]))
def test_bins_keep_every_constraint(lengths, rule, documents, attention):
    lengths = np.array(sorted(lengths, reverse=True), np.int64)
    bins = b.best_fit(lengths, 100, documents, attention, rule=rule)
    for i in set(bins.tolist()):
        mine = lengths[bins == i]
        assert mine.sum() <= 100 and len(mine) <= documents and (mine**2).sum() <= attention


def test_best_fit_fills_the_fullest_bin():
    assert b.best_fit(np.array([60, 50, 40, 39]), 100).tolist() == [0, 1, 0, 1]
    with pytest.raises(ValueError):
        b.best_fit(np.array([101]), 100)
