"""Quoted passages linked to the messages they come from, and conversations in reply order without quotes.

Only DataFrame functions. Quote marks are parsed line by line inside the row; blocks of one level become
passages, and their normalised text is hashed. The original of a passage is the first message of
the conversation that holds it as text of its own, so originals are a minimum per hash, computed
before the shuffle, and a passage that everybody quotes is joined with one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.session import materialize

MARK, LEVEL = "\x01", "\x02"
QUOTED = r"^[ \t]*>"
MARKS = r"^[ \t>]*"
WROTE = r"(?i)\b(wrote|schrieb|écrit|escribió) ?:[ \t]*$"


def normal(text: Column) -> Column:
    """Lower case, white space collapsed."""
    return F.btrim(F.regexp_replace(F.lower(text), r"[ \t\n\x0B\f\r]+", " "))


def _level(line: Column) -> Column:
    marks = F.regexp_extract(line, MARKS, 0)
    return F.when(line.rlike(QUOTED), F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))).otherwise(0)


def parse(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, lines, levels, own``: quote level of each line, and the unquoted text.

    A line that announces a quote ("... wrote:") right above a quoted line is no text of the message's own.
    """
    plain = F.translate(F.coalesce("text", F.lit("")), MARK + LEVEL + "\r", "")
    rows = messages.select("conv_id", "turn", "role", "text", F.split(plain, "\n", -1).alias("lines"))
    rows = rows.withColumn("levels", F.transform("lines", _level))

    def own(line: Column, i: Column) -> Column:
        follows = F.coalesce(F.get("levels", i + 1), F.lit(0)) > 0
        return (F.get("levels", i) == 0) & ~(follows & line.rlike(WROTE))

    text = F.array_join(F.filter("lines", own), "\n")
    return rows.withColumn("own", F.regexp_replace(F.btrim(text, F.lit(" \t\n")), r"\n[ \t]*\n[ \t\n]*", "\n\n"))


def passages(parsed: DataFrame) -> DataFrame:
    """``conv_id, turn, block, level, passage, key``: runs of lines of one level, without blank lines."""

    def marked(line: Column, i: Column) -> Column:
        content = F.when(F.get("levels", i) > 0, F.regexp_replace(line, MARKS, "")).otherwise(line)
        before = F.get("lines", i - 1)
        new = (
            (i == 0)
            | (F.get("levels", i) != F.get("levels", i - 1))
            | (F.btrim(F.regexp_replace(before, MARKS, ""), F.lit(" \t")) == "")
        )
        start = F.concat(F.lit(MARK), F.get("levels", i).cast("string"), F.lit(LEVEL))
        return F.concat(F.when(new, start).otherwise(""), content)

    runs = F.split(F.array_join(F.transform("lines", marked), "\n"), MARK)
    blocks = parsed.select("conv_id", "turn", F.posexplode(runs).alias("block", "run")).filter("run <> ''")
    text = F.btrim(F.substring_index("run", LEVEL, -1), F.lit("\n"))
    return blocks.select(
        "conv_id",
        "turn",
        "block",
        F.substring_index("run", LEVEL, 1).cast("int").alias("level"),
        text.alias("passage"),
        normal(text).alias("normal"),
    ).filter("normal <> ''").withColumn("key", F.md5("normal")).drop("normal")


def links(parsed: DataFrame) -> DataFrame:
    """``conv_id, turn, block, level, source``: quoted passages and the turn of their first appearance.

    A passage comes from a message if it equals a block of that message's own lines, or all of its own text.
    """
    blocks = materialize(passages(parsed), "passages")
    whole = parsed.select("conv_id", "turn", F.md5(normal(F.col("own"))).alias("key"), (normal(F.col("own")) != "").alias("some"))
    own = blocks.filter("level = 0").select("conv_id", "turn", "key").unionByName(whole.filter("some").drop("some"))
    first = materialize(own.groupBy("conv_id", "key").agg(F.min("turn").alias("source")), "originals")
    return blocks.filter("level > 0").join(first, ["conv_id", "key"]).filter("source < turn").select("conv_id", "turn", "block", "level", "source")


def _roots(parents: DataFrame) -> DataFrame:
    """``conv_id, turn, root, depth`` of the replies, by doubling the steps towards the root."""
    at = materialize(parents.select("conv_id", "turn", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")), "replies")
    while True:
        up = at.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("higher"), F.col("depth").alias("more"))
        moved = at.join(up, ["conv_id", "root"], "left").select(
            "conv_id", "turn", F.coalesce("higher", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("higher").isNotNull().alias("go")
        )
        moved = materialize(moved, "replies")
        at = moved.drop("go")
        if moved.filter("go").limit(1).count() == 0:
            return at


def reply_order(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, role, parent, root, depth, quotes, text``, sorted by conversation, root and turn.

    ``parent`` is the message that the least nested linked quotes come from (the latest of several); a message
    without one starts a thread: ``root`` is its own turn and ``depth`` 0. ``quotes`` counts linked
    passages; ``text`` is the message without quotes. A parent precedes its replies.

    Null and empty texts have no passages and an empty text. Rows without ``conv_id`` or ``turn`` are linked with
    nothing and keep a null root. Repeated rows of a turn are all returned; as a source they are one message.
    Empty tables give empty tables, other columns do not matter. Long conversations are sorted by range, so
    that one of any length spreads over many tasks.
    """
    parsed = parse(messages)
    found = materialize(links(parsed), "quote-links")
    best = found.groupBy("conv_id", "turn").agg(
        F.max(F.struct((-F.col("level")).alias("near"), "source")).alias("best"), F.countDistinct("block").alias("quotes")
    )
    replies = materialize(best.select("conv_id", "turn", F.col("best.source").alias("parent"), "quotes"), "parents")
    placed = replies.join(_roots(replies), ["conv_id", "turn"])
    out = parsed.select("conv_id", "turn", "role", F.col("own").alias("text")).join(placed, ["conv_id", "turn"], "left")
    out = out.select(
        "conv_id", "turn", "role", "parent", F.when(F.col("conv_id").isNotNull(), F.coalesce("root", "turn")).alias("root"),
        F.coalesce("depth", F.lit(0).cast("long")).alias("depth"), F.coalesce("quotes", F.lit(0).cast("long")).alias("quotes"), "text",
    )
    return out.repartitionByRange("conv_id", "root", "turn").sortWithinPartitions("conv_id", "root", "turn", "text")
