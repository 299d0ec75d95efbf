"""Reply-ordered conversations from messages that quote one another.

Lines that begin with ``>`` are quoted, once for each ``>``. Consecutive lines of one
level make a passage; its words, whatever their white space, are hashed as a whole
and line by line, and joined to the latest earlier message of the conversation that
has such a text or line of its own. That message is the one replied to; a message
without a found quotation replies to the one before it. Conversations are then put
in reply order: a message, followed by its replies in turn, each with its own.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.llm.words import mapped
from precis.operators.skew import running_before, with_positions
from precis.session import stage_table

# A single quoted line counts from so many words on; shorter ones are found anywhere.
LINE_WORDS = 3
_LEAD = re.compile(r"[ \t]*>[> \t]*")


def _hash(words: list[bytes]) -> int:
    h = xxhash.xxh64_intdigest(b" ".join(words))
    return h - (1 << 64) if h >> 63 else h


def _units(lines: list[str]) -> list[tuple[bool, int]]:
    """(whole, hash) of a passage and of its longer lines."""
    words = [line.encode().lower().split() for line in lines]
    whole = [w for line in words for w in line]
    out = [(True, _hash(whole))] if whole else []
    return out + [(False, _hash(line)) for line in words if len(line) >= LINE_WORDS]


def parse(text: str) -> tuple[str, list[dict]]:
    """A message without its quoted lines, and the level, wholeness and hash of each quoted unit."""
    if ">" not in text:
        return text, []
    body, passages = [], []
    last = 0
    for line in text.split("\n"):
        lead = _LEAD.match(line)
        level = lead.group().count(">") if lead else 0
        if level:
            if level != last:
                passages.append((level, []))
            passages[-1][1].append(line[lead.end() :])
        else:
            body.append(line)
        last = level
    if not passages:
        return text, []
    quotes = [{"level": n, "whole": w, "h": h} for n, lines in passages for w, h in _units(lines)]
    return "\n".join(body).strip(" \t\n\r\x0b\x0c"), quotes


def _parsed(df: DataFrame) -> DataFrame:
    quote = pa.list_(pa.struct([("level", pa.int32()), ("whole", pa.bool_()), ("h", pa.int64())]))

    def split(batch):
        done = [parse(t or "") for t in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array([b for b, _ in done], pa.string()), pa.array([q for _, q in done], quote)],
            names=["conv", "turn", "role", "body", "quotes"],
        )

    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in ("conv", "turn", "role"))
    return mapped(df, split, f"{kinds}, body string, quotes array<struct<level:int,whole:boolean,h:long>>")


def _own_units(messages: DataFrame) -> DataFrame:
    """``(conv, pos, h)`` of the texts and lines of messages."""

    def units(batch):
        found = [sorted({h for _, h in _units(t.split("\n"))}) for t in batch.column(2).to_pylist()]
        rows = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(rows), batch.column(1).take(rows), pa.array([h for x in found for h in x], pa.int64())],
            names=["conv", "pos", "h"],
        )

    kind = messages.schema["conv"].dataType.simpleString()
    return mapped(messages.select("conv", "pos", "body"), units, f"conv {kind}, pos long, h long")


def _links(messages: DataFrame) -> DataFrame:
    """``(conv, pos, linked)``: the message that a message's quotations lead to."""
    quotes = stage_table(messages.select("conv", "pos", F.inline("quotes")), "quotes")
    quoting = messages.join(quotes.select("conv").distinct(), "conv", "left_semi")
    wanted = quotes.select("conv", "h").distinct()
    sources = _own_units(quoting).join(wanted, ["conv", "h"], "left_semi")
    rows = quotes.withColumn("source", F.lit(None).cast("long")).unionByName(
        sources.withColumn("source", F.col("pos")), allowMissingColumns=True
    )
    # A quotation stands before its own message's text, which it cannot mean.
    rows = rows.withColumn("_late", F.col("source").isNotNull().cast("int"))
    order = ["pos", "_late", "level", "whole"]
    placed = with_positions(rows.withColumnRenamed("pos", "at").withColumn("pos_", F.col("at")), ["at", *order[1:]], ["conv", "h"])
    found = running_before(placed, ["conv", "h"], "source", "max", "found")
    found = found.where("source is null and found is not null")
    counted = found.groupBy("conv", F.col("at").alias("pos"), "level", "whole", "found").agg(F.count(F.lit(1)).alias("n"))
    best = F.max(F.struct((-F.col("level")).alias("near"), "whole", "n", "found"))
    return counted.groupBy("conv", "pos").agg(best["found"].alias("linked"))


def _threaded(nodes: DataFrame) -> DataFrame:
    """``(conv, pos, position)`` of messages with a ``parent``: their place in reply order.

    Each message is entered and left; what follows each of these steps is known
    from its children, next sibling and parent. Doubling the stride along these
    steps counts the entries up to the end in a logarithmic number of joins, so
    neither a long thread nor a large conversation is gathered.
    """
    nodes = stage_table(nodes.select("conv", "pos", "parent"), "threads")
    replies = nodes.where(F.col("parent").isNotNull())
    first = replies.groupBy("conv", F.col("parent").alias("pos")).agg(F.min("pos").alias("child"))
    listed = replies.select("conv", "parent", F.col("pos").alias("node"))
    listed = stage_table(with_positions(listed, ["node"], ["conv", "parent"]), "siblings")
    after = listed.select("conv", "parent", F.col("node").alias("sibling"), (F.col("pos") - 1).alias("pos"))
    siblings = listed.join(after, ["conv", "parent", "pos"]).select("conv", F.col("node").alias("pos"), "sibling")
    known = nodes.join(first, ["conv", "pos"], "left").join(siblings, ["conv", "pos"], "left")
    enter, leave = 2 * F.col("pos"), 2 * F.col("pos") + 1
    steps = known.select(
        "conv",
        F.inline(
            F.array(
                F.struct(enter.alias("step"), F.coalesce(2 * F.col("child"), leave).alias("next"), F.lit(1).cast("long").alias("n")),
                F.struct(
                    leave.alias("step"),
                    F.coalesce(2 * F.col("sibling"), 2 * F.col("parent") + 1).alias("next"),
                    F.lit(0).cast("long").alias("n"),
                ),
            )
        ),
    )
    steps = stage_table(steps, "tour")
    while steps.where(F.col("next").isNotNull()).limit(1).count():
        ahead = steps.select("conv", F.col("step").alias("next"), F.col("next").alias("_next"), F.col("n").alias("_n"))
        steps = stage_table(
            steps.join(ahead, ["conv", "next"], "left").select(
                "conv", "step", F.col("_next").alias("next"), (F.col("n") + F.coalesce("_n", F.lit(0))).alias("n")
            ),
            "tour",
        )
    sizes = nodes.groupBy("conv").agg(F.count(F.lit(1)).alias("size"))
    entered = steps.where("step % 2 = 0").select("conv", (F.col("step") / 2).cast("long").alias("pos"), "n")
    return entered.join(sizes, "conv").select("conv", "pos", (F.col("size") - F.col("n")).alias("position"))


def formatted(role: Column, body: Column) -> Column:
    """One turn as text: its role's tag, its text and an end tag; tags inside the text are broken up."""
    safe = F.replace(body, F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("unknown")), F.lit("|>\n"), safe, F.lit("<|end|>\n"))


def reply_ordered(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``(conv, turn, role, position, reply_to, n_quotes, text)`` of every message, ``text`` formatted without quotes.

    ``position`` numbers the messages of a conversation in reply order from 0;
    ``reply_to`` is the position of the message replied to, null for the first.
    ``n_quotes`` counts quoted passages and lines. Messages of one turn follow their
    role and a hash of their text; null turns come first, a null text is empty. A
    message without a conversation is one of its own. An empty table gives no rows.
    Nothing is gathered by conversation: places come from range shuffles, quotations
    from running maxima, reply order from joins.
    """
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    parsed = _parsed(rows).withColumn("_hash", F.xxhash64("body"))
    own = with_positions(parsed.where(F.col("conv").isNotNull()), ["turn", "role", "_hash"], ["conv"]).drop("_hash")
    own = stage_table(own, "messages")
    links = stage_table(_links(own), "links")
    threads = links.where(F.col("linked") != F.col("pos") - 1).select("conv").distinct()
    before = F.when(F.col("pos") > 0, F.col("pos") - 1)
    parents = own.join(links, ["conv", "pos"], "left").withColumn("parent", F.coalesce("linked", before)).drop("linked")
    nodes = own.select("conv", "pos").join(threads, "conv", "left_semi").join(links, ["conv", "pos"], "left")
    places = stage_table(_threaded(nodes.withColumn("parent", F.coalesce("linked", before))), "places")
    to = places.select("conv", F.col("pos").alias("parent"), F.col("position").alias("reply_place"))
    out = parents.join(places, ["conv", "pos"], "left").join(to, ["conv", "parent"], "left")
    out = out.select(
        "conv", "turn", "role", "body", "quotes",
        F.coalesce("position", "pos").alias("position"), F.coalesce("reply_place", "parent").alias("reply_to"),
    )
    alone = parsed.where(F.col("conv").isNull()).drop("_hash")
    out = out.unionByName(alone.withColumns({"position": F.lit(0).cast("long"), "reply_to": F.lit(None).cast("long")}))
    return out.select(
        "conv", "turn", "role", "position", "reply_to",
        F.size("quotes").alias("n_quotes"), formatted(F.col("role"), F.col("body")).alias("text"),
    )
