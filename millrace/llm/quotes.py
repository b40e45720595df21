"""Chat formatting by quotation linking, with DataFrame functions only.

A message may quote others by lines that begin with ``>``, one for each level. Its quoted
passages (neighbouring lines of one level, and each of those lines by itself) are
normalised and hashed, and so are the original texts of the conversation: whole messages,
their paragraphs and their lines, without what they quote themselves. A passage is linked to
the earliest message that holds it. A message answers what it quotes at the lowest level;
answers and what they answer make a thread, and a conversation is put in order by threads,
so that every answer stands behind what it answers, with quotes taken out.

Only conversations with quotes are cut into lines. Per passage and conversation one row is
kept of the originals, so no two large groups are ever joined; what is put in order is
dealt out by range, so a conversation of any size is no single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.ordered import running_totals
from ..session import checkpoint_root

_LEAD = r"^[ \t>]*"
_QUOTED = r"(^|\n)[ \t]*>"
_BLANK = " \t\n\r\f"


def _level(line: Column) -> Column:
    lead = F.regexp_extract(line, _LEAD, 0)
    return F.length(lead) - F.length(F.replace(lead, F.lit(">"), F.lit("")))


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def own_text(text: Column) -> Column:
    """A message without its quoted lines and without blank space at either end."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    kept = F.array_join(F.filter(lines, lambda x: _level(x) == 0), "\n")
    return F.btrim(F.when(text.rlike(_QUOTED), kept).otherwise(F.coalesce(text, F.lit(""))), F.lit(_BLANK))


def passages(messages: DataFrame) -> DataFrame:
    """``(conv, turn, level, hash, whole)``: quoted passages of ``messages(conv, turn, row, text)``.

    A passage is a run of lines of one level (``whole``) and each line of it. ``row`` tells
    messages of one turn apart; equal messages quote alike and are cut into lines once.
    """
    quoting = messages.where(F.col("text").rlike(_QUOTED)).select("conv", "turn", "row", "text").distinct()
    lines = quoting.select(
        "conv", "turn", "row", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    leveled = lines.select("conv", "turn", "row", "at", _level(F.col("line")).alias("level"),
                           F.regexp_replace("line", _LEAD, "").alias("body")).where("level > 0")
    # lines of one level that follow each other share their place less their rank
    rank = F.row_number().over(Window.partitionBy("row", "level").orderBy("at"))
    runs = leveled.withColumn("run", F.col("at") - rank)
    whole = (
        runs.groupBy("conv", "turn", "row", "level", "run")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "body"))), lambda x: x["body"]), " ").alias("body"))
        .select("conv", "turn", "level", "body", F.lit(True).alias("whole"))
    )
    single = runs.select("conv", "turn", "level", "body", F.lit(False).alias("whole"))
    text = _normal(F.col("body"))
    return whole.unionByName(single).select("conv", "turn", "level", F.sha2(text, 256).alias("hash"), "whole").where(text != "").distinct()


def originals(messages: DataFrame) -> DataFrame:
    """``(conv, hash, first)``: the earliest turn that holds each text, paragraph or line."""
    own = own_text(F.col("text"))
    units = F.array_distinct(F.concat(F.array(own), F.split(own, r"\n[ \t]*\n"), F.split(own, "\n")))
    unit = _normal(F.col("unit"))
    return (
        messages.select("conv", "turn", F.explode(units).alias("unit"))
        .select("conv", "turn", F.sha2(unit, 256).alias("hash")).where(unit != "")
        .groupBy("conv", "hash").agg(F.min("turn").alias("first"))
    )


def links(messages: DataFrame) -> DataFrame:
    """``(conv, turn, reply_to)``: what each quoting message answers, the latest of the
    originals of its lowest linked level, whole passages before single lines."""
    quoted = passages(messages).checkpoint()
    some = quoted.select("conv").distinct()
    held = originals(messages.join(some, "conv", "left_semi"))
    order = F.struct(-F.col("level"), F.col("whole"), F.col("first"))
    return (
        quoted.join(held, ["conv", "hash"]).where("first < turn")
        .groupBy("conv", "turn").agg(F.max(order).alias("best"))
        .select("conv", "turn", F.col("best.first").alias("reply_to"))
    )


def threads(replies: DataFrame) -> DataFrame:
    """``(conv, turn, thread)``: the first message of each answer's thread, by pointer doubling."""
    state = replies.withColumnRenamed("reply_to", "thread").checkpoint()
    while True:
        above = state.select("conv", F.col("turn").alias("thread"), F.col("thread").alias("up"))
        moved = state.join(above, ["conv", "thread"], "left").select(
            "conv", "turn", F.coalesce("up", "thread").alias("thread"), F.col("up").isNotNull().alias("moved")).checkpoint()
        state = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return state


def conversations(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """``(conv_id, turn, role, reply_to, thread, position, text)``: reply-ordered, without quotes.

    ``reply_to`` is the turn that the message answers (null if it quotes nothing that an
    earlier turn holds), ``thread`` the turn that its thread begins with (its own without
    an answer), ``position`` its place in the conversation from 0, by thread, turn, and then
    role and MD5 of the text. ``text`` has no quoted lines (null: empty). A message with a null
    conversation or turn is linked to nothing; null conversations are ordered as one. Rows
    that share a turn answer alike, each row stays. Other columns are not read.
    """
    checkpoint_root(messages.sparkSession)
    rows = messages.select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"),
    )
    known = rows.where("conv IS NOT NULL AND turn IS NOT NULL AND text IS NOT NULL")
    named = known.select("conv", "turn", "text", F.xxhash64("conv", "turn", "role", "text").alias("row"))
    replies = links(named).checkpoint()
    placed = replies.join(threads(replies), ["conv", "turn"])
    clean = rows.select("conv", "turn", "role", own_text(F.col("text")).alias("text")).join(placed, ["conv", "turn"], "left")
    keyed = clean.select(
        "conv", "turn", "role", "reply_to", F.coalesce("thread", "turn").alias("thread"), "text",
        F.md5("text").alias("tie"), F.monotonically_increasing_id().alias("row"),
    )
    order = [F.col(k) for k in ("conv", "thread", "turn", "role", "tie", "row")]
    upto = running_totals(keyed, order, {"upto": F.lit(1)}).drop("tie", "row").checkpoint()
    first = upto.groupBy(F.col("conv").alias("conv_id")).agg(F.min("upto").alias("first"))
    return upto.join(first, F.col("conv").eqNullSafe(F.col("conv_id"))).select(
        "conv_id", "turn", "role", "reply_to", "thread", (F.col("upto") - F.col("first")).alias("position"), "text"
    )
