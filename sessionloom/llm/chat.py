"""Conversations in reply order, without quoted text.

Quote levels are the leading ``>`` marks of lines (``> > text`` is level 2), in any nesting, and
attribution lines before a quote (``… wrote:``) belong to it.  Quoted passages, normalised (marks,
case, punctuation and white space do not count), are hashed line by line and joined to the lines
that other messages wrote themselves: first to the nearest earlier message of the conversation,
then, for passages from elsewhere, to the first message that wrote them.  A message replies to the
message that most of its outermost quoted lines come from (ties: the nearest), else to none.

Threads follow replies to their root by pointer jumping; (thread, depth, turn) is the reading
order.  A line that a third of all messages share is one row per conversation and hash before it
is joined.

Defined results: null and empty texts are messages without text; a message that only quotes keeps
its place with an empty text; a repeated (conversation, turn) is linked as one message and each row
is returned; messages without conversation or turn are returned unlinked; a quoted line without
original links nothing; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.workspace import materialize

_MARKS = re.compile(r"^\s*((?:>\s?)+)")
_WROTE = re.compile(r"^\s*(?:on|am|el|le|il)\b.*(?:wrote|schrieb|escribió|écrit|ha scritto)\s*:\s*$|^\s*\S.*\bwrote:\s*$", re.IGNORECASE)
_NORMAL = re.compile(r"[\W_]+")


def parse(text: str) -> tuple[str, list[tuple[int, str]], list[str]]:
    """Own text; (level, line) of quoted lines; own lines.  Lines are normalised, empty ones left out."""
    own, quoted = [], []
    for line in text.split("\n"):
        marks = _MARKS.match(line)
        if marks:
            if not (own and own[-1] is None):
                own.append(None)  # a quote was here
            quoted.append((marks[1].count(">"), _NORMAL.sub(" ", line[marks.end() :].lower()).strip()))
        else:
            own.append(line)
    kept = []
    for k, line in enumerate(own):
        if line is None:
            while kept and (not kept[-1].strip() or _WROTE.match(kept[-1])):
                kept.pop()
            continue
        kept.append(line)
    lines = [n for line in kept if (n := _NORMAL.sub(" ", line.lower()).strip())]
    return "\n".join(kept).strip(), [(level, line) for level, line in quoted if line], lines


def _parsed(messages: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    def parsed(batches):
        for batch in batches:
            bodies, quotes, lines = [], [], []
            for source in batch["text"].to_pylist():
                body, quoted, own = parse(source or "")
                bodies.append(body)
                quotes.append([{"level": n, "hash": xxhash.xxh3_64_intdigest(q) - (1 << 63)} for n, q in quoted])
                lines.append(sorted({xxhash.xxh3_64_intdigest(line) - (1 << 63) for line in own}))
            yield pa.RecordBatch.from_pydict(
                {
                    "conv_id": batch["conv_id"],
                    "turn": batch["turn"],
                    "role": batch["role"],
                    "text": pa.array(bodies, pa.string()),
                    "quotes": pa.array(quotes, pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.int64())]))),
                    "lines": pa.array(lines, pa.list_(pa.int64())),
                }
            )

    rows = messages.select(
        F.col(conversation).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.col(role).alias("role"), F.col(text).alias("text"),
    )
    return rows.mapInArrow(
        parsed, "conv_id long, turn long, role string, text string, quotes array<struct<level:int,hash:long>>, lines array<long>"
    )


def reply_links(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, to_conv, to_turn): the message each quoting message replies to."""
    whole = parsed.where("conv_id is not null and turn is not null")
    quotes = whole.select("conv_id", "turn", F.explode("quotes").alias("q")).select("conv_id", "turn", "q.level", "q.hash")
    outer = quotes.groupBy("conv_id", "turn", "hash").agg(F.min("level").alias("level"))
    # Only lines that somebody quotes are looked at among the originals.
    wanted = outer.select("hash").distinct()
    lines = whole.select("conv_id", "turn", F.explode("lines").alias("hash")).join(wanted, "hash", "left_semi").distinct()
    both = outer.select("conv_id", "turn", "hash", "level", F.lit(None).cast("long").alias("from")).union(
        lines.select("conv_id", "turn", "hash", F.lit(None).cast("int"), F.col("turn"))
    )
    before = Window.partitionBy("conv_id", "hash").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    near = both.withColumn("near", F.max("from").over(before)).where("level is not null")
    first = lines.groupBy("hash").agg(F.min(F.struct("conv_id", "turn")).alias("first"))
    found = near.join(first, "hash", "left").select(
        "conv_id", "turn", "level",
        F.when(F.col("near").isNotNull(), F.struct(F.col("conv_id").alias("conv_id"), F.col("near").alias("turn")))
        .when(F.col("first.conv_id") != F.col("conv_id"), F.col("first")).alias("to"),
    )
    votes = found.where("to is not null").groupBy("conv_id", "turn", "to").agg(
        F.min("level").alias("level"), F.count("*").alias("votes")
    )
    best = votes.groupBy("conv_id", "turn").agg(
        F.max(F.struct((-F.col("level")).alias("outer"), "votes", (F.col("to.conv_id") == F.col("conv_id")).alias("same"), F.col("to.turn").alias("t"), F.col("to.conv_id").alias("c"))).alias("b")
    )
    return best.select("conv_id", "turn", F.col("b.c").alias("to_conv"), F.col("b.t").alias("to_turn"))


def threads(links: DataFrame) -> DataFrame:
    """(conv_id, turn, root_conv, root_turn, depth) of every message that replies, by pointer jumping.

    Within a conversation replies go back in time.  Links between conversations could form a
    circle; those that do not point to a smaller (conversation, turn) count as roots here.
    """
    back = (F.col("to_conv") < F.col("conv_id")) | ((F.col("to_conv") == F.col("conv_id")) & (F.col("to_turn") < F.col("turn")))
    reach = materialize(links.where(back).select("conv_id", "turn", F.col("to_conv").alias("root_conv"), F.col("to_turn").alias("root_turn"), F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        further = reach.select(
            F.col("conv_id").alias("root_conv"), F.col("turn").alias("root_turn"),
            F.col("root_conv").alias("c"), F.col("root_turn").alias("t"), F.col("depth").alias("d"),
        )
        reach = reach.join(further, ["root_conv", "root_turn"], "left").select(
            "conv_id", "turn", F.coalesce("c", "root_conv").alias("root_conv"), F.coalesce("t", "root_turn").alias("root_turn"),
            (F.col("depth") + F.coalesce("d", F.lit(0))).alias("depth"), F.col("c").isNotNull().alias("moved"),
        )
        reach = materialize(reach, "threads")
        if reach.where("moved").isEmpty():
            return reach.drop("moved")
        reach = reach.drop("moved")


def reply_ordered(
    messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, turn, role, text (own), n_quoted, reply_conv, reply_turn, thread_conv, thread_turn, depth."""
    parsed = _parsed(messages, conversation, turn, role, text)
    links = materialize(reply_links(parsed), "links")
    placed = links.join(threads(links), ["conv_id", "turn"], "left")
    return parsed.join(placed, ["conv_id", "turn"], "left").select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.size("quotes").cast("long").alias("n_quoted"),
        F.col("to_conv").alias("reply_conv"),
        F.col("to_turn").alias("reply_turn"),
        F.coalesce("root_conv", "conv_id").alias("thread_conv"),
        F.coalesce("root_turn", "turn").alias("thread_turn"),
        F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
    )
