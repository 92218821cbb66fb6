import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st

from clickweave.llm import components as c, divide_skip as d
from llm_help import no_docs, odd_docs, rows  # noqa: F401

LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute(pairs):
    sets = {i: shingle_set(t) for i, (_, t) in enumerate(pairs)}
    parent = list(range(len(pairs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in sets.items():
        for j in range(i):
            common = len(a & sets[j])
            if None not in (pairs[i][0], pairs[j][0]) and a and 100 * common >= 80 * (len(a) + len(sets[j]) - common):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    least = {}
    for i, (name, _) in enumerate(pairs):
        if name is not None:
            least[root(i)] = min(name, least.get(root(i), name))
    return sorted(((n, len(sets[i]), least.get(root(i)) if n is not None else None) for i, (n, _) in enumerate(pairs)), key=repr)


def check(docs, **settings_):
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows(d.jaccard_components(docs, **settings_), "doc_id", "n_shingles", "component_id") == brute(pairs)


def family(draw, size, words=60, edits=4):
    """Texts around one original, near and not so near."""
    base = [f"w{draw.randrange(500)}" for _ in range(words)]
    out = []
    for _ in range(size):
        text = list(base)
        for _ in range(draw.randrange(edits + 1)):
            text[draw.randrange(words)] = f"x{draw.randrange(10_000)}"
        out.append(" ".join(text))
    return out


def test_odd_rows(odd_docs):
    check(odd_docs)


def test_empty_table(no_docs):
    assert d.jaccard_components(no_docs).collect() == []


def test_families_in_one_and_in_many_blocks(spark):
    draw = random.Random(3)
    said = [t for size in (2, 3, 40, 90) for t in family(draw, size)] + [t for _ in range(60) for t in family(draw, 1, 40)]
    passage = " ".join(f"p{i}" for i in range(50))
    said += [passage + " " + t for t in (family(draw, 1, 30)[0] for _ in range(40))]  # share much, link rarely
    draw.shuffle(said)
    docs = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string").repartition(5)
    check(docs)
    check(docs, block_docs=7)  # outside of the largest component, sets are searched in other blocks


def test_a_hot_class(spark):
    docs = spark.range(900).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'a b c d e f g', concat('t', id, ' q r s t u v w x y z')) AS text")
    check(docs)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=20).map(lambda x: sorted(set(x))), max_size=14), st.integers(1, 8))
def test_searches_find_what_counting_finds(lists, least):
    counts = Counter(i for values in lists for i in values)
    want = sorted((i, n) for i, n in counts.items() if n >= least)
    assert sorted(d.merge_skip([v for v in lists if v], least)) == want
    assert sorted(d.divide_skip([v for v in lists if v], least)) == want


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(2, 25))
def test_joined_connects_what_all_pairs_connect(seed, size):
    draw = random.Random(seed)
    sets = [np.unique(np.array([draw.randrange(14) for _ in range(draw.randrange(1, 12))], np.uint64)) for _ in range(size)]
    pairs = [(i, j) for i in range(size) for j in range(i) if d.links(len(sets[i]), len(sets[j]), len(np.intersect1d(sets[i], sets[j])), 80)]

    def parts(edges):
        union = d._Union(size)
        for i, j in edges:
            union.tie(i, j)
        return [[union.root(i) == union.root(j) for j in range(size)] for i in range(size)]

    found = d.joined(sets, 80)
    assert set(map(frozenset, found)) <= set(map(frozenset, pairs)) and parts(found) == parts(pairs)


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 301), (301, 300)]
    got = rows(c.components(spark.createDataFrame(edges, "u long, v long")))
    assert got == sorted([(i, 0) for i in range(41)] + [(i, 100) for i in range(100, 160)] + [(300, 300), (301, 300)], key=repr)
    assert c.components(spark.createDataFrame([], "u long, v long")).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 400), st.integers(1, 400), st.integers(0, 400))
def test_sketches_never_lose_a_link(seed, n, m, common):
    draw = np.random.default_rng(seed)
    common = min(common, n, m)
    every = np.unique(draw.integers(0, 2**63, n + m, dtype=np.uint64) * np.uint64(2))
    a, b = every[:n], np.concatenate([every[:common], every[n : n + m - common]])
    x, y = (np.frombuffer(d.sketch(s), "u1").astype(np.int64) for s in (a, b))
    if d.links(len(a), len(b), common, 80):
        assert d.may_link(len(a), x, len(b), y, 80)


def test_runs_over_batches_and_partitions(spark):
    draw = random.Random(9)
    said = [t for size in (3, 90, 150, 2, 2, 70) for t in family(draw, size, 30, 2)]
    docs = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string").repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        check(docs, block_docs=16)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
