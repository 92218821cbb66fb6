import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import __spark_entry__ as app
import corpus_pipeline as cp
from clickweave.llm import best_fit, pfair_mix, quality
from clickweave.llm.queries import BUILDERS, SQL
from llm_help import no_docs, odd_docs  # noqa: F401
from test_mix import check as check_mix
from test_near import brute as near
from test_packing import ids_of
from tools.check import TABLES, rows_of

LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def test_registered():
    assert set(BUILDERS) | {"pipeline"} <= set(app.queries()) and set(SQL) <= set(app.oracle_sql())
    assert sorted(int(k[2:].split("_")[0]) for k in BUILDERS) == list(range(1, 14))


@pytest.mark.parametrize("key", sorted(SQL))
def test_sql(spark, small, key):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    assert rows_of(BUILDERS[key](spark, small).toArrow()) == rows_of(con.sql(SQL[key]).to_arrow_table())


def test_stages_against_brute_force(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    for number, (name, stage) in enumerate(cp.STAGES):
        stage(spark, docs, small).write.parquet(f"{tmp_path}/{number}")
        after = spark.read.parquet(f"{tmp_path}/{number}")
        before = {r.doc_id: r for r in docs.collect()}
        if name != "pack":
            kept = {r.doc_id: r for r in after.collect()}
            assert after.columns == columns and all(before[i] == r for i, r in kept.items()) and len(kept) == after.count()
        if name == "quality":
            judged = quality.judge(docs, spark.read.parquet(f"{small}/labels.parquet"))
            assert set(kept) == {r.doc_id for r in judged.collect() if r.predicted}
        elif name == "exact_dedup":
            best = {}
            for i, r in before.items():
                key = hashlib.sha256(r.text.translate(LOWER).encode()).digest()
                best[key] = max(i, best.get(key, i))
            assert set(kept) == set(best.values())
        elif name == "near_dedup":
            assert set(kept) == {c for _, _, c in near([(i, r.text) for i, r in before.items()])}
        elif name == "mix":
            assert set(kept) == set(before)
        else:
            rows = after.toPandas()
            for i, r in before.items():
                ids, mine = ids_of(r.text), rows[rows["doc_id"] == i].sort_values("piece")
                for p in mine.itertuples():
                    assert zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32
                assert mine["length"].sum() == len(ids)
            assert rows.groupby("sequence_id")["length"].sum().max() <= 2048
        docs = after


def test_odd_rows_and_no_rows_pass(spark, small, odd_docs, no_docs, tmp_path):
    for docs, label in ((odd_docs, "odd"), (no_docs, "none")):
        for number, (_, stage) in enumerate(cp.STAGES):
            stage(spark, docs, small).write.parquet(f"{tmp_path}/{label}{number}")
            docs = spark.read.parquet(f"{tmp_path}/{label}{number}")
    assert docs.count() == 0


def test_mix_keeps_targets(spark, small):
    check_mix(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "source"), 2, 100)


def test_sequences_follow_the_weights(spark, small, tmp_path):
    draw = random.Random(4)
    texts = [(i, " ".join(draw.choices(["alpha", "beta", "gamma", "delta"], k=draw.randrange(20, 900))), f"src{i // 600}") for i in range(3600)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string")
    # many files of unequal size, named in the mixed order
    mixed = cp.mix(spark, docs, small)
    mixed.write.option("maxRecordsPerFile", 170).parquet(f"{tmp_path}/mixed")
    got = cp.pack(spark, spark.read.parquet(f"{tmp_path}/mixed"), small).toPandas().sort_values(["sequence_id", "offset"])
    assert sorted(got["doc_id"]) == list(range(3600))
    true, done, docs_seen = {"src0": 0.4, "src1": 0.2, "src2": 0.1, "src3": 0.1, "src4": 0.1, "src5": 0.1}, Counter(), 0
    first = got[got["sequence_id"] // 2**32 == 0]  # a block of the first phase, which src0 ends after 1,500 documents
    assert 800 <= len(first) <= 1100
    for _, s in first.groupby("sequence_id"):
        done.update(f"src{i // 600}" for i in s["doc_id"])
        docs_seen += len(s)
        assert docs_seen < 100 or all(abs(done[n] / docs_seen - w) < 0.1 for n, w in true.items())
    assert all(abs(done[n] - w * docs_seen) <= 16 for n, w in true.items())  # at a block's end, to one block of documents
    later = [set(g["doc_id"]) for _, g in got.groupby(got["sequence_id"] // 2**32)]
    order = [r.doc_id for r in pfair_mix.mix(docs, cp.MIX_WEIGHTS).select("row.doc_id", "position").orderBy("position").collect()]
    for block in later:
        assert set(order[: len(block)]) == block
        order = order[len(block) :]


def test_long_documents_keep_their_place(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "IF(id % 7 = 0, repeat('one two three ', 90), concat('short ', id)) AS text", "10 * id AS at").repartition(5)
    got = best_fit.pack(docs, cp.TOKENIZER, tokens=64, block_rows=100, order="at", keep_ids=True).toPandas()
    want = {r.doc_id: ids_of(r.text) for r in docs.collect()}
    for i, mine in got.sort_values("piece").groupby("doc_id"):
        assert np.frombuffer(b"".join(mine["ids"]), "<u4").tolist() == want[i]
    totals = got.groupby("sequence_id")["length"].sum()
    assert totals.max() == 64 and got["length"].sum() == sum(map(len, want.values()))
    spans = got.groupby(got["sequence_id"] // 2**32)["doc_id"].agg(["min", "max"])
    assert len(spans) > 5 and (spans["max"].to_numpy()[:-1] <= spans["min"].to_numpy()[1:]).all()


def test_near_dedup_tells_rows_of_one_doc_id_apart(spark, small, tmp_path):
    one = " ".join(f"a{i}" for i in range(60))
    two = " ".join(f"b{i}" for i in range(60))
    rows = [
        (7, one, "x"), (7, two, "x"), (5, one + " more", "x"), (None, two + " end", "x"), (9, "quite another text of few words", "x"),
        (9, "and one more that is nothing like it", "x"), (None, "rows without a name stay too", "x"), (None, None, None), (9, "", "x"),
    ]
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3).write.parquet(f"{tmp_path}/docs")
    got = cp.near_dedup(spark, spark.read.parquet(f"{tmp_path}/docs"), small).collect()
    gone = {(7, one, "x"), (None, two + " end", "x")}
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(r) for r in rows if r not in gone)
