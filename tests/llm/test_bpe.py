import codecs
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from clickweave.llm import bpe_transducer as b
from clickweave.llm.queries import BUILDERS, RANKS
from llm_help import no_docs, odd_docs, rows  # noqa: F401

OURS = b.read_ranks(RANKS)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=OURS, special_tokens={})
ENCODER = b.Encoder(OURS, public_tokenizers.PATTERN)
DECODER = b.Decoder({number: token for token, number in OURS.items()})


def ids_of(text):
    return memoryview(ENCODER(text)).cast("i").tolist()


PARTS = [" ", "  ", "\n", "\t", "'s", "'", "don't", "a", "B", "Wörter", "中文", "😀", "12", "3", "!?", "<|endoftext|>", "\0", "é", "\x1c", "　", "ﬁ", "़", "\xa0", "x" * 40]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS) | st.text(max_size=4), max_size=12).map("".join))
def test_like_the_library(text):
    text = text.encode("utf-8", "replace").decode()
    assert ids_of(text) == LIBRARY.encode_ordinary(text)
    assert DECODER(ids_of(text)) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(sorted(OURS)), max_size=8).map(b"".join) | st.binary(max_size=60) | st.text("abeinrst", max_size=60).map(str.encode))
def test_any_bytes_as_one_piece(piece):
    if not piece:
        return
    assert ENCODER.transducer(piece) == LIBRARY._encode_single_piece(piece)
    assert [OURS[t] for t in ENCODER.transducer.merges.plain(piece)] == ENCODER.transducer(piece)


def test_tokens_that_stay_apart():
    draw, merges, tokens = random.Random(2), b.Merges(OURS), sorted(OURS)
    together = 0
    for _ in range(20_000):
        x, y = draw.choice(tokens), draw.choice(tokens)
        if draw.random() < 0.5:
            whole = draw.choice(tokens) + draw.choice(tokens)
            cut = draw.randrange(1, len(whole))
            x, y = whole[:cut], whole[cut:]
            if x not in OURS or y not in OURS:
                continue
        assert merges.apart(x, y) == (merges.plain(x + y) == [x, y])
        together += not merges.apart(x, y)
    assert together > 100


@pytest.mark.parametrize("piece", [b"a" * 60_000, b"ab" * 30_000, bytes(random.Random(1).choices(b"abc", k=60_000))])
def test_long_pieces_are_emitted_on_the_way(piece):
    asked = []

    def chunks():
        for i in range(0, len(piece), 1000):
            asked.append(i)
            yield piece[i : i + 1000]

    got, seen = [], []
    for number in ENCODER.transducer.stream(chunks()):
        got.append(number)
        seen.append(asked[-1])
    assert got == LIBRARY._encode_single_piece(piece)
    assert seen[0] < 6000  # the first token does not wait for the end
    assert ENCODER.transducer(piece) == got


def test_states_are_bounded():
    small, draw = b.Transducer(OURS, states=50), random.Random(3)
    for _ in range(300):
        piece = "".join(draw.choices("abcdefgh", k=9)).encode()
        assert small(piece) == LIBRARY._encode_single_piece(piece)
        assert len(small.states) <= 60


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([0x41, 0x80, 0xBF, 0xC0, 0xC2, 0xE0, 0xA0, 0xED, 0x9F, 0xF0, 0x90, 0xF4, 0x8F, 0xFF, 0xE2, 0x82]), max_size=12).map(bytes) | st.binary(max_size=20))
def test_utf8_machine(said):
    ids = [OURS[bytes([x])] for x in said]
    assert DECODER(ids) == said.decode("utf-8", "replace")


def test_characters_come_out_when_they_are_complete():
    said = "aé中😀b".encode()
    whole = codecs.getincrementaldecoder("utf-8")()
    assert list(DECODER.stream([OURS[bytes([x])] for x in said])) == [whole.decode(bytes([x])) for x in said]


def want(name, text):
    text = text or ""
    ids = LIBRARY.encode_ordinary(text)
    return name, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def test_the_query(spark, small, odd_docs, no_docs, tmp_path):
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    table = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert rows(BUILDERS["op11_bpe_transducer"](spark, small), *names) == sorted((want(*r) for r in table), key=repr)
    for docs, label in ((odd_docs.selectExpr("*", "'x' AS ids", "1 AS decoded"), "odd"), (no_docs, "none")):
        docs.write.parquet(f"{tmp_path}/{label}/documents.parquet")
        got = rows(BUILDERS["op11_bpe_transducer"](spark, f"{tmp_path}/{label}"), *names)
        assert got == sorted((want(r.doc_id, r.text) for r in docs.collect()), key=repr)


def test_null_ids(spark):
    df = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert rows(b.decode(df, RANKS), "doc_id", "decoded") == [(1, ""), (2, "")]


def test_both_ways_in_one_worker_or_in_two(spark, odd_docs):
    one = b.round_trip(odd_docs, RANKS, public_tokenizers.PATTERN)
    two = b.decode(b.encode(odd_docs, RANKS, public_tokenizers.PATTERN), RANKS)
    assert rows(one, "doc_id", "ids", "decoded") == rows(two, "doc_id", "ids", "decoded")
