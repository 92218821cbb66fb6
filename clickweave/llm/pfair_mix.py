"""Mixing sources to target weights by Pfair scheduling.

Every source is cut into blocks of ``block_rows`` documents. With target weight w, its j-th block (from 1) is
released at slot floor((j - 1) / w) and due by slot ceil(j / w); of the released blocks the one with the
earliest deadline gets the next slot (ties: first source in order). At every slot each source has then had its
weight's share of the slots, to less than one block.

Weights are exact: as whole numbers without a common divisor (decimals as they are written), their sum is the
period after which the schedule repeats, so one period tells the slot of every block by arithmetic. When a source
runs out, the weights of the others are scaled up and a new phase begins with a period of its own; there are at
most as many phases as sources. The driver makes the slots of one period of each phase, or of the whole phase
where that is shorter, so never more than the table has blocks, whatever the weights and however many sources;
above ``max_numbers`` it raises. All documents come out, each once. Only if ``period`` is given are weights rounded
to that many parts (largest remainders, at least one), and the shares are those of the parts.

Documents are numbered within their source by one sort over range partitions, so a source may hold any share
of the rows. Only the table of sources (the slots above, checked) is copied to every task. All that touches rows is
DataFrame and SQL functions.

A null source is a source of its own. Sources without a given weight have weight ``default``. Equal rows and
rows without a doc_id are documents like others. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from fractions import Fraction
from heapq import heappop, heappush
from itertools import islice
from math import gcd, lcm

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickweave.operators.ordering import with_position


def shares(weights: list[float], period: int) -> list[int]:
    """Whole parts of ``period``, in proportion to the weights, at least one each."""
    if len(weights) > period:
        raise ValueError(f"{len(weights)} sources need a period of at least as many slots")
    exact = [Fraction(w) for w in weights]
    total = sum(exact)
    ideal = [w * period / total for w in exact]
    parts = [max(1, int(x)) for x in ideal]
    while sum(parts) < period:
        at = max(range(len(parts)), key=lambda i: ideal[i] - parts[i])
        parts[at] += 1
    while sum(parts) > period:
        at = max((i for i in range(len(parts)) if parts[i] > 1), key=lambda i: parts[i] - ideal[i])
        parts[at] -= 1
    return parts


def exact_parts(weights: list[float]) -> list[int]:
    """The smallest whole numbers in proportion to the weights; a decimal counts as it is written."""
    exact = [Fraction(str(w)) for w in weights]
    over = lcm(*(w.denominator for w in exact))
    whole = [int(w * over) for w in exact]
    common = gcd(*whole)
    return [w // common for w in whole]


def schedule(parts: list[int]) -> Iterator[int]:
    """The source of every slot, without end: earliest deadline first among the released blocks."""
    period, slot = sum(parts), 0
    waiting = [(0, i, 0) for i in range(len(parts))]  # (released at, source, block)
    ready: list[tuple[int, int, int]] = []  # (due, source, block)
    while True:
        while waiting and waiting[0][0] <= slot:
            _, i, block = heappop(waiting)
            heappush(ready, (-(-(block + 1) * period // parts[i]), i, block))
        _, i, block = heappop(ready)
        heappush(waiting, ((block + 1) * period // parts[i], i, block + 1))
        yield i
        slot += 1


def one_period(_: SparkSession, parts: list[int]) -> list[int]:
    """The source of every slot of a period."""
    return list(islice(schedule(parts), sum(parts)))


def phases(blocks: list[int], weights: list[float], period: int | None, max_numbers: int) -> list[dict]:
    """Per phase: its first slot and period, and per source still in it the blocks before, its part and its slots."""
    left, done, start, found, numbers = list(blocks), [0] * len(blocks), 0, [], 0
    while any(left):
        active = [i for i, n in enumerate(left) if n]
        wanted = [weights[i] for i in active]
        parts = exact_parts(wanted) if period is None else shares(wanted, period)
        whole = sum(parts)
        slots: list[list[int]] = [[] for _ in active]
        numbers += len(active)
        for slot, pick in enumerate(islice(schedule(parts), whole)):
            numbers += 1
            if numbers > max_numbers:
                raise ValueError("too many slots or sources for the driver")
            slots[pick].append(slot)
            if len(slots[pick]) == left[active[pick]]:  # runs out in the first period; later slots are not needed
                break
        # the slot after each source's last block; the phase ends with the first of them
        ends = [
            (left[i] - 1) // a * whole + s[(left[i] - 1) % a] + 1
            for i, a, s in zip(active, parts, slots) if (left[i] - 1) % a < len(s)
        ]
        end = min(ends)
        lines = []
        for i, a, s in zip(active, parts, slots):
            lines.append((i, done[i], a, s))
            taken = end // whole * a + sum(x < end % whole for x in s)
            left[i] -= taken
            done[i] += taken
        found.append({"start": start, "period": whole, "sources": lines})
        start += end
    return found


def _slot(block: int, source: int, plan: list[dict]) -> int:
    """The slot of a block, as the SQL below finds it for all rows."""
    phase = [(p["start"], p["period"], *line[1:]) for p in plan for line in p["sources"] if line[0] == source and line[1] <= block][-1]
    start, period, before, part, slots = phase
    return start + (block - before) // part * period + slots[(block - before) % part]


def mix(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, default: float = 1.0, block_rows: int = 16, period: int | None = None,
    doc_id: str = "doc_id", source: str = "source", max_numbers: int = 10_000_000,
) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``), source, block and position of every row, from 0 without gaps."""
    spark = docs.sparkSession
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), F.col(source).cast("string").alias("source"), F.col(doc_id).alias("doc_id")
    )
    # One line per source, in the order of the sort below.
    counts = rows.groupBy("source").count().orderBy("source").collect()
    given = dict(weights or {})
    wanted = [float(given.get(line["source"], default)) for line in counts]
    if any(w <= 0 for w in wanted):
        raise ValueError("weights must be positive")
    blocks = [-(-line["count"] // block_rows) for line in counts]
    plan = phases(blocks, wanted, period, max_numbers)
    # Only the last block of a source may be short; places after it move up.
    short = [
        (_slot(blocks[i] - 1, i, plan), blocks[i] * block_rows - line["count"])
        for i, line in enumerate(counts) if line["count"] % block_rows
    ]
    lookup, before = [], 0
    for i, line in enumerate(counts):
        steps = [(p["start"], p["period"], *mine[1:]) for p in plan for mine in p["sources"] if mine[0] == i]
        lookup.append((line["source"], before, steps))
        before += line["count"]
    step = "array<struct<start: long, period: long, before: long, part: long, slots: array<int>>>"
    table = spark.createDataFrame(lookup, f"name string, first long, steps {step}")
    gaps = F.array(*[F.struct(F.lit(s).cast("long").alias("slot"), F.lit(n).cast("long").alias("gap")) for s, n in short])

    numbered = with_position(rows, ["source", "doc_id"], "place")
    placed = numbered.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("name")))
    number = F.col("place") - 1 - F.col("first")
    placed = placed.select("row", "source", "steps", (number % block_rows).alias("inside"), F.floor(number / block_rows).alias("block"))
    phase = F.element_at(F.filter("steps", lambda s: s["before"] <= F.col("block")), -1)
    placed = placed.select("row", "source", "block", "inside", phase.alias("phase"))
    past = F.col("block") - F.col("phase.before")
    in_period = F.element_at("phase.slots", (past % F.col("phase.part")).cast("int") + 1)
    slot = F.col("phase.start") + F.floor(past / F.col("phase.part")) * F.col("phase.period") + in_period
    placed = placed.select("row", "source", "block", "inside", slot.cast("long").alias("slot"))
    moved = F.lit(0).cast("long")
    if short:
        earlier = F.filter(gaps, lambda g: g["slot"] < F.col("slot"))
        moved = F.aggregate(earlier, F.lit(0).cast("long"), lambda a, g: a + g["gap"])
    position = F.col("slot") * block_rows + F.col("inside") - moved
    return placed.select("row", "source", "block", "slot", position.cast("long").alias("position"))


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, with their columns, in files that follow the mixed order."""
    placed = mix(docs, **settings)
    return placed.repartitionByRange("position").sortWithinPartitions("position").select("row.*")
