from collections import Counter
from fractions import Fraction

import pytest

from clickweave.llm import pfair_mix as p
from conftest import plan
from llm_help import no_docs, odd_docs, rows  # noqa: F401


def deviations(spark, parts):
    period = sum(parts)
    done, worst = [0] * len(parts), 0.0
    for t, pick in enumerate(p.one_period(spark, parts), 1):
        done[pick] += 1
        worst = max(worst, *(abs(n - t * a / period) for n, a in zip(done, parts)))
    return done, worst


@pytest.mark.parametrize("parts", [[1], [1, 1], [5, 3, 2], [97, 1, 1, 1], [50, 30, 7, 7, 6], [1] * 17 + [83]])
def test_less_than_one_block_from_the_target_at_every_slot(spark, parts):
    done, worst = deviations(spark, parts)
    assert done == parts and worst < 1


def test_shares():
    assert p.shares([1, 1, 1], 10) in ([4, 3, 3], [3, 4, 3], [3, 3, 4])
    assert p.shares([1e9, 1], 10) == [9, 1] and sum(p.shares([0.3, 0.2, 7], 1000)) == 1000
    with pytest.raises(ValueError):
        p.shares([1] * 11, 10)


def check(docs, block_rows, period, weights=None):
    got = p.mix(docs, weights, block_rows=block_rows, period=period).select("row.*", "position", "slot", "block").orderBy("position").collect()
    assert [r.position for r in got] == list(range(docs.count()))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in got) == sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in docs.collect())
    sizes = Counter(r.source for r in got)
    names = sorted(sizes, key=lambda n: (n is not None, n or ""))
    blocks = [r.source for i, r in enumerate(got) if i == 0 or (r.slot, r.source) != (got[i - 1].slot, got[i - 1].source)]
    assert len(blocks) == sum(-(-n // block_rows) for n in sizes.values())
    left, t = {n: -(-sizes[n] // block_rows) for n in names}, 0
    while t < len(blocks):  # phase by phase
        active = [n for n in names if left[n]]
        parts = dict(zip(active, p.shares([(weights or {}).get(n, 1.0) for n in active], period)))
        done, start = Counter(), t
        while t < len(blocks) and all(left[n] for n in active):
            done[blocks[t]] += 1
            left[blocks[t]] -= 1
            t += 1
            assert all(abs(done[n] - (t - start) * parts[n] / period) < 1 for n in active)


def test_every_phase_keeps_its_targets(spark):
    docs = spark.range(700).selectExpr("id AS doc_id", "concat('t', id) AS text", "IF(id % 3 = 0, 'hot', concat('s', id % 7)) AS source", "'x' AS position").drop("position")
    check(docs, 4, 30, {"hot": 5.0, "s1": 0.5})
    check(docs, 1, 10)


def test_odd_rows(odd_docs):
    check(odd_docs.drop("shard", "node"), 2, 10)


def test_empty_table_and_columns(no_docs, odd_docs):
    assert p.mix(no_docs).collect() == []
    assert p.mixed(odd_docs).columns == odd_docs.columns and p.mixed(odd_docs).count() == odd_docs.count()


def test_no_python_in_the_plan(odd_docs):
    shown = plan(p.mixed(odd_docs))
    assert not any(word in shown for word in ("Python", "Pandas", "Arrow", "Cartesian"))


def test_true_weights_over_thousands_of_slots(spark):
    weights = {"s00": 4.0, "s01": 2.0, "s02": 0.3}
    names = [f"s{i:02}" for i in range(20)]
    true = [Fraction(str(weights.get(n, 1.0))) for n in names]
    total = sum(true)
    docs = spark.range(7000).selectExpr("id AS doc_id", "CASE WHEN id < 1300 THEN 's00' WHEN id < 2000 THEN 's01' ELSE concat('s', lpad(2 + id % 18, 2, '0')) END AS source")
    sizes = Counter(r.source for r in docs.collect())
    got = [r.source for r in p.mix(docs, weights, block_rows=1).orderBy("position").collect()]
    done = Counter()
    for t, name in enumerate(got, 1):
        done[name] += 1
        assert all(abs(done[n] - t * w / total) < 1 for n, w in zip(names, true))
        if done[name] == sizes[name]:  # a new phase
            break
    assert t > 5000


def test_more_sources_than_a_thousand(spark):
    docs = spark.range(3600).selectExpr("id AS doc_id", "concat('s', id % 1200) AS source")
    got = [r.source for r in p.mix(docs, block_rows=1).orderBy("position").collect()]
    assert all(len(set(got[at : at + 1200])) == 1200 for at in (0, 1200, 2400))


def test_awkward_weights_make_no_more_slots_than_there_are_blocks():
    plan = p.phases([50, 30, 7], [1 / 3, 0.123456789, 7.7], None, 200)
    assert sum(sum(len(s) for *_, s in phase["sources"]) for phase in plan) <= 87
    assert p.exact_parts([0.3, 0.2, 7.0]) == [3, 2, 70] and p.exact_parts([4.0, 2.0] + [1.0] * 18) == [4, 2] + [1] * 18
