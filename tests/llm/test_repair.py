import hashlib
import heapq
import random
import re
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from clickweave.llm import chat_repair as c
from clickweave.llm.queries import BUILDERS
from llm_help import rows

LEGAL = re.compile("(s?(ua)+)?")


def brute(pairs, costs=c.Costs()):
    """All audits by rising cost and then by letters, checked against the grammar as written; no lattice, no states."""
    seen, found = set(), []
    for role, text in pairs:
        visible = re.sub("[\x20\x09-\x0d]", "", text)
        found.append("blank" if not visible else "duplicate" if (role, text) in seen else "" if visible[-1] in ".!?" else "truncated")
        seen.add((role, text))
    heap, popped = [(0, "", 0, ())], 0
    while True:
        cost, audit, i, out = heapq.heappop(heap)
        popped += 1
        spelled = "".join(r[:1] or "?" for r, _ in out)  # no role is no legal role
        if i == len(pairs) and LEGAL.fullmatch(spelled):
            return cost, audit, list(out)
        if spelled and not any(LEGAL.fullmatch(spelled + end) for end in ("", "ua", "a")):
            continue
        if i < len(pairs):
            role, text = pairs[i]
            late = costs.truncated * (found[i] == "truncated")
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, out))
            if found[i] not in ("blank", "duplicate"):
                heapq.heappush(heap, (cost + late, audit + "K", i + 1, (*out, (role, text))))
                for new in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 1 + late, audit + "R", i + 1, (*out, (new, text))))
        for new in ("user", "assistant"):
            heapq.heappush(heap, (cost + 5, audit + "I", i, (*out, (new, ""))))


def check(pairs):
    cost, audit, out = brute(pairs)
    got = c.repair_rows([None] * len(pairs), pairs)
    assert got[5:7] == (cost, audit), (pairs, got, cost, audit)
    assert got[7] == "\n".join(f"{r}:{t}" for r, t in out)


ROWS = st.tuples(st.sampled_from(["user", "assistant", "system", "user", "assistant", "tool", "", " "]), st.sampled_from(["Hi.", "cut", "", " \t", "Yes!", "No? ", "é", "other."]))


@settings(max_examples=400, deadline=None)
@given(st.lists(ROWS, max_size=5))
def test_against_all_edits(pairs):
    check(pairs)


def test_ties_take_the_least_letters():
    for pairs in (
        [("user", "a."), ("user", "b."), ("assistant", "c.")], [("user", "a.")], [("system", "s."), ("user", "a.")], [("assistant", "a.")],
        [("user", "a."), ("assistant", "b."), ("user", "c")], [("system", "s.")], [("user", "a."), ("user", "a."), ("user", "b")],
    ):
        check(pairs)


def plain_cost(pairs):
    """The cost alone, by a table over (row, state) from left to right."""
    found, best = c.faults(pairs), {0: 0}
    for (role, _), fault in zip(pairs, found):
        late, after = 5 * (fault == "truncated"), {}

        def put(state, cost):
            after[state] = min(cost, after.get(state, 10**9))

        for state, cost in list(best.items()):
            for steps in range(3):
                put(state, cost + 2)
                if fault in ("", "truncated"):
                    if role[:1] in c.NEXT[state]:
                        put(c.NEXT[state][role[:1]], cost + late)
                    put(next(iter(c.SAID[state].values())), cost + 1 + late)
                state, cost = next(iter(c.SAID[state].values())), cost + 5
        best = after
    return min(best.get(0, 10**9), best.get(3, 10**9), best.get(1, 10**9) + 10, best.get(2, 10**9) + 5)


@pytest.mark.parametrize("size", [30, 300, 20_000])
def test_long_conversations(size):
    draw = random.Random(size)
    pairs = [(draw.choice(["user", "assistant", "assistant", "system", "tool"]), draw.choice([f"t{i}.", f"t{i}", "", "same."])) for i in range(size)]
    *_, cost, audit, text = c.repair_rows(list(range(size)), pairs)
    assert cost == plain_cost(pairs) and len(audit.replace("I", "")) == size
    assert LEGAL.fullmatch("".join(line.split(":")[0][:1] for line in text.split("\n") if line))


def expected(table):
    """What the contract says of every conversation, row by row."""
    told = {}
    for conv, turn, role, text in table:
        mine = told.setdefault(conv, [])
        blank = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [((turn is not None, turn), "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, mine in told.items():
        mine.sort(key=lambda r: (r[0][0], r[0][1] or 0, r[1], r[2]))
        turns = {t for (known, t), _, _ in mine if known}
        pairs = [(r, t) for _, r, t in mine]
        found = c.faults(pairs)
        letters = [r[:1] for r, _ in pairs]
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(letters, letters[1:]))
        cost, audit, left = brute(pairs)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *[found.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha))
    return sorted(out, key=repr)


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def test_the_query_on_odd_rows(spark, tmp_path):
    draw = random.Random(3)
    texts = ["Hi.", "cut off", None, "", " \n", "Well? Yes! ", "same.", "é…", "x" * 50_000 + "."]
    table = [(conv, turn * 2, draw.choice(["user", "assistant", "system", None, ""]), draw.choice(texts)) for conv in range(200) for turn in range(draw.randrange(1, 5))]
    table += [(None, 1, "user", "A."), (None, 2, "assistant", "B."), (500, None, "user", "A."), (500, None, "assistant", "B."), (501, 3, "user", "A."), (501, 3, "user", "A.")]
    dropped = next(i for i in range(1000, 2000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    table += [(dropped, 0, "user", "gone.")]
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS told", "1 AS left", "2 AS copy", "3 AS kind")
    df.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = rows(BUILDERS["op13_chat_repair"](spark, str(tmp_path)), *COLUMNS)
    assert got == expected(table)
    assert (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got


def test_the_query_on_the_smallest_tables(spark, small):
    table = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = rows(BUILDERS["op13_chat_repair"](spark, small), *COLUMNS)
    short = {conv for conv, *_ in expected([r for r in table if sum(x[0] == r[0] for x in table) <= 6])}
    want = expected([r for r in table if r[0] in short])
    assert [r for r in got if r[0] in short] == want and len(got) == len({r[0] for r in table})


def test_no_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert c.repair(c.damaged(empty), left=c.F.col("left")).collect() == []
