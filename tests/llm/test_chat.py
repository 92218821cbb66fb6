import duckdb
from hypothesis import given, settings, strategies as st

from clickweave.llm import chat_format as c
from clickweave.llm.queries import BUILDERS, SQL
from conftest import plan
from llm_help import rows
from tools.check import rows_of

COLUMNS = "conv long, seq long, turn long, kind string, role string, text string"


def told(spark, events):
    back = c.read_back(c.render_chats(spark.createDataFrame(events, COLUMNS)))
    return {r.conv: ([(m.role, m.text) for m in r.messages], r.learned) for r in back.collect()}


def test_deltas_edits_and_regenerations(spark):
    events = [
        (1, 1, 0, "message", "user", "hi"), (1, 2, 1, "delta", "assistant", "he"), (1, 4, 1, "delta", None, "o"), (1, 3, 1, "delta", None, "ll"),
        (1, 5, 0, "edit", None, "hey"), (1, 6, 2, "delta", "assistant", "bad"), (1, 7, 2, "regenerate", None, None), (1, 8, 2, "delta", None, "good"),
        (2, 1, 0, None, None, None), (2, 2, 1, "odd kind", "assistant", "x"), (None, 1, None, "message", "user", "n"), (None, 1, 5, "message", "assistant", "m"),
        (1, 4, 1, "delta", None, "o"),
    ]
    got = told(spark, events)
    assert got[1] == ([("user", "hey"), ("assistant", "helloo"), ("assistant", "good")], "helloogood")
    assert got[2] == ([("", ""), ("assistant", "x")], "x")
    assert got[None] == ([("user", "n"), ("assistant", "m")], "m")


def test_empty_log(spark):
    assert c.render_chats(spark.createDataFrame([], COLUMNS)).collect() == []


PARTS = ["<|im_end|>", "<|im_start|>", "assistant", "\n", "\\", "<", "|", "<\\|", "é", "中", "😀", "a", " ", "$1", ">"]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=8).map("".join)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "sys\ntem", "<|im_start|>", "\\"]) | TEXTS, TEXTS), min_size=1, max_size=5), min_size=1, max_size=25))
def test_round_trip(spark, chats):
    events = [(i, t, t, "message", role, text) for i, chat in enumerate(chats) for t, (role, text) in enumerate(chat)]
    got = told(spark, events)
    for i, chat in enumerate(chats):
        assert got[i] == ([tuple(m) for m in chat], "".join(t for r, t in chat if r == "assistant"))


def test_long_texts_and_many_turns(spark):
    long = "x<|\\\n" * 100_000
    events = [(1, 0, 0, "message", "assistant", long)] + [(2, i, i, "message", "assistant", str(i)) for i in range(3000)]
    got = told(spark, events)
    assert got[1] == ([("assistant", long)], long)
    assert got[2][1] == "".join(map(str, range(3000))) and len(got[2][0]) == 3000


def test_extra_columns_and_a_native_plan(spark):
    log = spark.createDataFrame([(1, 1, 1, "message", "user", "a")], COLUMNS).selectExpr("*", "'x' AS told", "1 AS piece", "2 AS start")
    df = c.read_back(c.render_chats(log))
    assert rows(df, "learned") == [("",)]
    assert not any(word in plan(df) for word in ("Python", "Pandas", "Arrow"))


def test_the_query_counts_rows_that_share_a_turn(spark, tmp_path):
    rows = [
        (1, 0, "user", "a"), (1, 0, "assistant", "b"), (1, 1, "assistant", "c"), (1, 1, "assistant", "c"), (2, None, "user", "d"),
        (2, None, "assistant", None), (2, 3, None, "e"), (None, 0, "user", "f"), (None, None, None, None), (3, 1, "assistant", "é<|"), (3, 1, "assistant", "e"),
    ]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    got = BUILDERS["op8_chat_format"](spark, str(tmp_path))
    assert rows_of(got.toArrow()) == rows_of(con.sql(SQL["op8_chat_format"]).to_arrow_table())
    assert {r.conv_id: (r.n_turns, r.loss_chars) for r in got.collect()} == {1: (4, 3), 2: (3, 0), None: (2, 0), 3: (2, 4), -1: (2, 34)}
    assert not any(word in plan(got) for word in ("Python", "Pandas", "Arrow"))
