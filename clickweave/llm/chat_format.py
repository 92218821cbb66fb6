"""Chat formatting: logs of events, folded into messages, rendered with a template and a loss mask.

An event is (conversation, sequence number, turn, kind, role, text):

* ``message``: the turn says ``text``; what it said before is gone;
* ``delta``: ``text`` is appended, as a stream of tokens would;
* ``edit``: the turn's text is replaced, its role stays unless the edit names one;
* ``regenerate``: the turn starts anew with no text.

Any other kind, and null, is a message. The last message, edit or regeneration of a turn, by sequence
number, starts its final text, and the deltas after it follow in order. Events with equal numbers are taken
in the order of kind, role and text, so equal rows in any order give equal results.

A turn is rendered as ``<|im_start|>role``, a line end, the text, ``<|im_end|>`` and a line end. Inside
roles and texts a backslash and the bar of ``<|`` get a backslash before them (in roles a line end too), so
no control string can be said, and ``unescaped`` gives back every text exactly.

Null conversations form one conversation, null turns one turn that comes first; a null role or text is empty.
An empty log gives no rows. Extra columns of the log are ignored. All is SQL functions. Rows are dealt by
conversation once. One conversation is one row of the result, so its text must fit a row (2 GB); there is no
other bound on its turns, and text offsets are running sums, not folds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\\n"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def folded(events: DataFrame) -> DataFrame:
    """Final messages (conv, turn, role, text) of a log (conv, seq, turn, kind, role, text)."""
    log = events.select(
        "conv", "turn", "seq",
        F.when(F.col("kind").isin("delta", "edit", "regenerate"), F.col("kind")).otherwise("message").alias("kind"),
        "role", F.coalesce("text", F.lit("")).alias("text"),
    )
    told = (
        log.repartition("conv")
        .groupBy("conv", "turn")
        .agg(F.array_sort(F.collect_list(F.struct("seq", "kind", "role", "text"))).alias("told"))
        .withColumn("starts", F.transform("told", lambda e, i: F.when(e["kind"] != "delta", i).otherwise(-1)))
        .withColumn("first", F.array_max("starts"))
    )
    last = F.filter("told", lambda e, i: i >= F.col("first"))
    said = F.transform(last, lambda e: F.when(e["kind"] == "regenerate", F.lit("")).otherwise(e["text"]))
    roles = F.filter(F.transform("told", lambda e: e["role"]), lambda r: r.isNotNull())
    return told.select(
        "conv", "turn", F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"), F.array_join(said, "").alias("text")
    )


def formatted(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """One row per conversation: ``formatted`` and ``loss``, the spans (start, size) of texts of role ``learn``.

    Offsets count code points from 0.
    """
    head = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"))
    pieces = messages.select(
        "conv", "turn", (F.col("role") == learn).alias("learn"), head.alias("head"), escaped(F.col("text")).alias("body")
    ).select("*", F.concat("head", "body", F.lit(END)).alias("piece"))
    before = W.partitionBy("conv").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    placed = pieces.select(
        "conv", "turn", "learn", "piece",
        (F.coalesce(F.sum(F.char_length("piece")).over(before), F.lit(0)) + F.char_length("head")).alias("start"),
        F.char_length("body").cast("long").alias("size"),
    )
    turns = F.array_sort(F.collect_list(F.struct("turn", "learn", "start", "size", "piece")))
    return placed.groupBy("conv").agg(turns.alias("turns")).select(
        "conv",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["learn"]), lambda t: F.struct(t["start"], t["size"])).alias("loss"),
    )


def render_chats(events: DataFrame, learn: str = "assistant") -> DataFrame:
    """The log's conversations, formatted: conv, formatted, loss."""
    return formatted(folded(events), learn)


def read_back(chats: DataFrame) -> DataFrame:
    """What the rendered text says: ``messages`` (role, text) in order, and ``learned``, the text under the mask."""
    parts = F.filter(F.split("formatted", r"<\|im_start\|>"), lambda p: p != "")
    # the head ends at the first line end that has no backslash before it
    head = r"(?s)^((?:[^\\\n]++|\\.)*+)\n"
    role = lambda p: F.regexp_extract(p, head, 1)
    message = lambda p: F.struct(
        unescaped(role(p)).alias("role"),
        unescaped(F.substring(p, F.char_length(role(p)) + 2, F.char_length(p) - F.char_length(role(p)) - 1 - len(END))).alias("text"),
    )
    under = F.transform(
        "loss", lambda s: F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["size"].cast("int"))
    )
    return chats.select("*", F.transform(parts, message).alias("messages"), F.array_join(F.transform(under, unescaped), "").alias("learned"))
