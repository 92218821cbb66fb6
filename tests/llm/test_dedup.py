import hashlib
import os

from clickweave.llm import mph_dedup as m
from llm_help import no_docs, odd_docs, rows  # noqa: F401

LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def brute(pairs):
    """Rows of dedup() from (doc_id, text) pairs."""
    groups = {}
    for name, text in pairs:
        groups.setdefault((text or "").translate(LOWER), []).append(name)
    out = []
    for text, names in groups.items():
        known = [n for n in names if n is not None]
        keep, left = max(known, default=None), True
        for n in sorted(names, key=lambda n: (n is None, n)):
            out.append((n, keep, len(names), n == keep and left, hashlib.sha256(text.encode()).hexdigest()))
            left = left and n != keep
    return sorted(out, key=repr)


def pairs_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_perfect_hash_gives_every_member_its_own_slot():
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(5000)]
    levels, bits = m.build(digests)
    assert sorted(m.slots(levels, bits, digests)) == list(range(5000))
    assert len(bits) * 8 < 5 * 5000
    assert m.build([]) == ([], b"")
    others = m.slots(levels, bits, [os.urandom(32) for _ in range(500)])
    assert others.min() >= -1 and others.max() < 5000


def test_equals_brute_force_on_odd_rows(odd_docs):
    got = rows(m.dedup(odd_docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == brute(pairs_of(odd_docs))


def test_empty_table(no_docs):
    assert m.dedup(no_docs).collect() == [] and m.keep_one(no_docs).collect() == []


def test_many_copies_in_parts(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'Hot', concat('t', id % 700)) AS text")
    folded = m.digested(docs)
    decided = m.lookup(folded, m.build_index(folded, shard_keys=64), part_rows=50)
    assert decided.where("member").count() == 3000 and decided.where("wins").count() == len({t for _, t in pairs_of(docs.selectExpr("doc_id", "lower(text) AS text"))})
    assert rows(m.dedup(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute(pairs_of(docs))


def test_history_removes_members_and_groups_the_rest(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (9, "B")], "doc_id long, text string")
    new = spark.createDataFrame([(3, "A"), (4, "c"), (5, "C"), (6, "b")], "doc_id long, text string")
    index = m.build_index(m.digested(old))
    got = rows(m.dedup(new, index), "doc_id", "keep_id", "group_size", "kept")
    assert got == [(3, 1, 1, False), (4, 5, 2, False), (5, 5, 2, True), (6, 9, 2, False)]
    assert rows(m.keep_one(new, index), "doc_id") == [(5,)]


def test_an_equal_slot_is_not_an_equal_digest(spark):
    old = spark.createDataFrame([(1, "a")], "doc_id long, text string")  # one slot, so every place leads to it
    index = m.build_index(m.digested(old))
    new = spark.range(200).selectExpr("id AS doc_id", "concat('x', id) AS text")
    assert m.dedup(new, index).where("kept").count() == 200


def test_rows_that_stay_keep_their_columns(odd_docs):
    kept = m.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    want = {(n, t) for n, t in pairs_of(odd_docs)}
    got = pairs_of(kept)
    assert set(got) <= want and len(got) == len({(t or "").translate(LOWER) for _, t in want})
    assert sorted((n for n, t in got if t == "same row")) == [7]
