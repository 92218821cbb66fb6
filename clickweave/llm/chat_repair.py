"""Conversation structure repair: the cheapest edits that give a legal order of roles, by bidirectional Dijkstra.

A conversation is legal if the first letters of its roles spell ``(s?(ua)+)?``: an optional system message, then
user and assistant in turn. Each row's first fault counts:

* ``blank``: no visible character; ``duplicate``: role and text stood earlier; both must be deleted;
* ``truncated``: the last visible character does not end a sentence; it costs ``truncated`` more to leave it in.

Edits, with their letters in the audit: K keeps a row, R gives it the role user or assistant, D deletes it, I inserts
an empty row of the role user or assistant. The lattice has a node for every (rows done, grammar state); an audit names
exactly one path. A forward heap from the start and a reverse heap from the legal ends are worked off in turn. They go
on until the sum of their least keys exceeds the best cost, so every node of every cheapest path is settled from one
side and all crossings of equal cost are known. Among the paths over those crossings the walk takes the smallest
letter at every node, which is the ASCII-least audit: two audits of one cost to one node are never prefixes of each
other, since what follows could only be insertions, which cost more.

Rows are ordered by turn, nulls first; rows of one turn by role and text. A null role or text is one blank (so such a
row is blank, or has no legal role; nor has one whose role is empty). Conversations without rows that are left have zeros, an empty audit and the hash
of the empty text; null conversations form one. An empty table gives an empty result. Extra columns are ignored.

Spark deals rows by conversation once and sorts them in the shuffle's aggregate; a Python task holds a batch of whole
conversations. One conversation is one row of the result, so it must fit one; time is n log n in its rows.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

VISIBLE = re.compile("[^\x20\x09-\x0d]")
# Grammar states: nothing said, after s, after u, after a. The last and the first are legal ends.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
SAID = ({"u": 2}, {"u": 2}, {"a": 3}, {"u": 2})  # the one role that an inserted or renamed row can have
ENDS = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
PAIRS = {"su", "ua", "au"}

_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired string"


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


def faults(rows: list[tuple[str, str]]) -> list[str]:
    """The first fault of each (role, text); empty if it has none."""
    seen, out = set(), []
    for role, text in rows:
        visible = VISIBLE.findall(text[-64:]) or VISIBLE.findall(text)
        if not visible:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if visible[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


class Lattice:
    """Edges between nodes ``4 * rows done + state``, found when asked for."""

    def __init__(self, initials: list[str], found: list[str], costs: Costs):
        self.n, self.costs = len(initials), costs
        # per row and state: (letter, next state, cost) of the edits that consume it
        self.over = []
        for initial, fault in zip(initials, found):
            late = costs.truncated if fault == "truncated" else 0
            row = []
            for state in range(4):
                edits = [("D", state, costs.delete)]
                if fault in ("", "truncated"):
                    if initial in NEXT[state]:
                        edits.append(("K", NEXT[state][initial], late))
                    edits += [("R", to, costs.rerole + late) for to in SAID[state].values()]
                row.append(edits)
            self.over.append(row)
        self.inserts = [[("I", to, costs.insert) for to in said.values()] for said in SAID]

    def ahead(self, node: int) -> list[tuple[str, int, int]]:
        """(letter, node, cost) of every edit from a node."""
        i, state = divmod(node, 4)
        out = [(letter, 4 * i + to, cost) for letter, to, cost in self.inserts[state]]
        if i < self.n:
            out += [(letter, 4 * i + 4 + to, cost) for letter, to, cost in self.over[i][state]]
        return out

    def behind(self, node: int) -> list[tuple[str, int, int]]:
        """(letter, node, cost) of every edit that leads to a node."""
        i, state = divmod(node, 4)
        out = [("I", 4 * i + q, cost) for q in range(4) for _, to, cost in self.inserts[q] if to == state]
        if i:
            out += [(letter, 4 * i - 4 + q, cost) for q in range(4) for letter, to, cost in self.over[i - 1][q] if to == state]
        return out


class _Side:
    """One of the two searches: its heap, the least keys met, and the nodes settled in their order."""

    def __init__(self, starts: list[int], edges):
        self.edges, self.met, self.settled, self.order = edges, dict.fromkeys(starts, 0), {}, []
        self.heap = [(0, node) for node in starts]

    def least(self) -> float:
        while self.heap and self.heap[0][1] in self.settled:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def settle(self, other: "_Side") -> float:
        """Settle the next node; the cost of the best path over it or its edges that the other side has met."""
        key, node = heapq.heappop(self.heap)
        self.settled[node] = key
        self.order.append(node)
        best = key + other.met.get(node, float("inf"))
        for _, to, cost in self.edges(node):
            if key + cost < self.met.get(to, float("inf")):
                self.met[to] = key + cost
                heapq.heappush(self.heap, (key + cost, to))
                best = min(best, key + cost + other.met.get(to, float("inf")))
        return best


def cheapest(lattice: Lattice) -> tuple[int, str, list[tuple[int, int]]]:
    """Cost, least audit and the nodes of its path."""
    front = _Side([0], lattice.ahead)
    back = _Side([4 * lattice.n + state for state in ENDS], lattice.behind)
    best = 0 if lattice.n == 0 else float("inf")
    # not until the keys' sum exceeds the best cost: then all crossings of equal cost are settled
    while (a := front.least()) + (b := back.least()) <= best:
        best = min(best, front.settle(back) if a <= b else back.settle(front))
    ends = {4 * lattice.n + state for state in ENDS}

    def on_best(spent: int, to: int) -> bool:
        """Whether a node that a cheapest path may reach at this cost is on one."""
        return spent + back.settled.get(to, float("inf")) == best or (to in good and spent == front.settled[to])

    good = {node for node in ends if front.settled.get(node) == best}
    for node in reversed(front.order):
        key = front.settled[node]
        if any(on_best(key + cost, to) for _, to, cost in lattice.ahead(node)):
            good.add(node)
    node, spent, audit, path = 0, 0, [], [0]
    while not (spent == best and node in ends):
        letter, node, cost = min((letter, to, cost) for letter, to, cost in lattice.ahead(node) if on_best(spent + cost, to))
        spent += cost
        audit.append(letter)
        path.append(node)
    return int(best), "".join(audit), path


def repaired(rows: list[tuple[str, str]], audit: str, path: list[int]) -> list[tuple[str, str]]:
    """The rows that an audit leaves and inserts."""
    out, at = [], 0
    for letter, node in zip(audit, path[1:]):
        role = "assistant" if node % 4 == 3 else "user"
        if letter == "I":
            out.append((role, ""))
            continue
        if letter != "D":
            out.append((rows[at][0] if letter == "K" else role, rows[at][1]))
        at += 1
    return out


def repair_rows(turns: list[int | None], rows: list[tuple[str, str]], costs: Costs = Costs()) -> tuple:
    """gaps, blank, duplicate, truncated, illegal, cost, audit and the repaired text of one ordered conversation."""
    known = {t for t in turns if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    found = faults(rows)
    initials = [role[:1] for role, _ in rows]
    illegal = sum(a + b not in PAIRS for a, b in zip(initials, initials[1:]))
    cost, audit, path = cheapest(Lattice(initials, found, costs))
    text = "\n".join(f"{role}:{said}" for role, said in repaired(rows, audit, path))
    return gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit, text


def repair(conversations: DataFrame, costs: Costs = Costs(), left: Column | None = None) -> DataFrame:
    """One row per conv_id of (conv_id, turn, role, text): the counts, cost, audit and ``repaired``, its text.

    Rows where ``left`` is false are gone, but their conversation is reported.
    """
    row = F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
    )
    kept = row if left is None else F.when(left, row)
    told = conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.array_sort(F.collect_list(kept)).alias("told"))

    def repairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for conv, rows in zip(batch["conv_id"].tolist(), batch["told"]):
                turns = [None if pd.isna(r["turn"]) else int(r["turn"]) for r in rows]
                out.append((None if pd.isna(conv) else int(conv), *repair_rows(turns, [(r["role"], r["text"]) for r in rows], costs)))
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in _RESULT.split(", ")])
            frame["conv_id"] = frame["conv_id"].astype("Int64")
            yield frame

    return told.mapInPandas(repairs, _RESULT)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults by crc32 of conv_id and turn, modulo 20: ``left`` is false for dropped ones.

    0 drops a row, 1 empties its text, 2 takes its sentence ends away, 3 repeats it, 4 makes its role user.
    """
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        "conv_id", "turn", named("role").alias("role"), named("text").alias("text"),
        (F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")) % 20).alias("kind"),
    )
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("kind") != 0).alias("left"), F.explode(times).alias("copy"),
    ).drop("copy")

