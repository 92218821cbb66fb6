import hashlib
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from clickweave.llm import minimax_shards as s
from llm_help import no_docs, odd_docs, rows  # noqa: F401


def brute_cuts(sizes, shards):
    """The smallest capacity, and the first groups of shards 1, 2, ...: all by looking at every border."""
    before = [0]
    for x in sizes:
        before.append(before[-1] + x)
    groups, total = len(sizes), before[-1]

    def used(capacity):
        n, left = 0, 0
        for x in sizes:
            if x > capacity:
                return shards + 1
            if x > left:
                n, left = n + 1, capacity
            left -= x
        return n

    low, high = 0, total
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if used(middle) <= shards else (middle + 1, high)
    latest = [groups]
    for _ in range(shards - 1):
        latest.append(next(g for g in range(groups + 1) if before[g] >= before[latest[-1]] - low))
    at, cuts = 0, []
    for left in range(shards - 1, 0, -1):
        want = before[at] + (total - before[at]) // (left + 1)
        under = max(g for g in range(groups + 1) if before[g] <= want)
        over = min(under + 1, groups)
        near = over if before[over] - want < want - before[under] else under
        most = max(g for g in range(groups + 1) if before[g] <= before[at] + low)
        near = min(max(near, latest[left], min(at + 1, groups)), most)
        at = min(near, groups - left) if groups - left > at else near
        cuts.append(at)
    return low, cuts


def brute(pairs, shards):
    """The largest load and (doc_id, shard, slot) of every row."""
    groups = {}
    for name, text in pairs:
        groups.setdefault(hashlib.sha256((text or "").encode()).digest(), []).append((name, len((text or "").encode()) + 1))
    order = sorted(groups)
    capacity, cuts = brute_cuts([sum(size for _, size in groups[k]) for k in order], shards) if order else (0, [])
    out, slots = [], [0] * shards
    for number, key in enumerate(order):
        shard = sum(cut <= number for cut in cuts)
        for name, _ in sorted(groups[key], key=lambda x: (x[0] is not None, x[0])):
            out.append((name, shard, slots[shard]))
            slots[shard] += 1
    return capacity, out


def check(docs, shards, points=8192):
    got = s.shard_by_bytes(docs, shards, points=points).collect()
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=repr) == sorted(
        ((n, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for n, t in texts), key=repr
    )
    loads, slots = {}, {}
    for r in got:
        loads[r["shard"]] = loads.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(loads) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    largest, places = brute(texts, shards)
    assert max(loads.values(), default=0) == largest
    assert sorted(((r.doc_id, r["shard"], r["slot"]) for r in got), key=repr) == sorted(places, key=repr)
    of = {}
    for r in got:
        of.setdefault((r["size"], r.text_crc32), set()).add(r["shard"])
    assert all(len(v) == 1 for v in of.values())


def test_odd_rows(odd_docs):
    check(odd_docs, 3)
    check(odd_docs, 1)
    check(odd_docs, 50)  # more shards than groups


def test_empty_table(no_docs):
    assert s.shard_by_bytes(no_docs, 8).collect() == []


def test_hot_group_and_few_points(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot text', repeat('x', cast(id % 97 AS int)) || id) AS text")
    check(docs, 8)
    check(docs, 8, points=5)  # the walk has to fetch finer points again and again
    check(docs, 256)


def in_memory(sizes, shards, points):
    before = [0]
    for x in sizes:
        before.append(before[-1] + x)
    known = s.Points(lambda wanted: [(g, before[g], g) for g in wanted], len(sizes), before[-1], len(sizes), max(points, 4 * shards))
    mean = -(-before[-1] // shards)
    capacity = s.smallest_capacity(known, shards, max(mean, max(sizes)), mean + max(sizes))
    return capacity, known.cuts(capacity, shards), known


SIZES = st.lists(st.sampled_from([1, 2, 3, 50, 300, 5000]) | st.integers(1, 400), min_size=1, max_size=60)


@settings(max_examples=200, deadline=None)
@given(SIZES, st.integers(1, 12), st.sampled_from([1, 2, 5, 100]))
def test_cuts_from_few_points(sizes, shards, points):
    capacity, cuts, _ = in_memory(sizes, shards, points)
    assert (capacity, cuts) == brute_cuts(sizes, shards)
    if len(sizes) >= shards:
        assert len({0, len(sizes), *cuts}) == shards + 1  # none is empty


@pytest.mark.parametrize("shards", [8, 256, 1000, 1024])
def test_many_shards_and_a_group_of_half_the_bytes(shards):
    sizes = [50 + i * 7919 % 4000 for i in range(100_000)]
    sizes[30_000] = sum(sizes)
    capacity, cuts, known = in_memory(sizes, shards, 8192)
    edges = [0, *cuts, len(sizes)]
    assert capacity == sizes[30_000] and all(a < b for a, b in zip(edges, edges[1:]))
    loads = sorted(sum(sizes[a:b]) for a, b in zip(edges, edges[1:]))
    assert loads[-2] < sum(sizes) / shards + 8000  # no other gets more than an equal share
    assert known.turns < 100 and len(known.known) < 120_000


def test_one_hot_text_leaves_no_shard_empty(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, repeat('h', 100), lpad(id, 100, 'x')) AS text")
    loads = s.shard_by_bytes(docs, 8).groupBy("shard").sum("size").collect()
    assert len(loads) == 8 and max(r[1] for r in loads) == 101_000


def test_sf(spark, small):
    check(spark.read.parquet(f"{small}/documents.parquet"), 8)
    assert rows(s.shard_by_bytes(spark.read.parquet(f"{small}/documents.parquet").limit(0), 8)) == []
