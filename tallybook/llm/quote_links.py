"""Chat formatting by quotation linking (DataFrame functions only).

A line's quote level is the number of ``>`` signs it begins with (blanks between
them allowed).  Lines of level 0 are the message's own body.  A quoted passage is a
run of lines of one level; its lines are normalised (signs off, lower case, white
space runs to one blank, ends stripped) and hashed.  The original of a quoted line
is the first message of the conversation whose own body has that line, if it comes
before the quoting message.  A message answers the original that most characters of
its level-1 lines come from (the later one of equals).  Deeper levels give links to
ancestors.

A conversation is returned without quotes in reply order: threads (messages that
lead to one root) by the root's turn, messages inside by turn, which puts every
answer after what it answers.

Originals are found with one aggregate per (conversation, line) before the join, so
a very common line or a very long conversation is never gathered in one task.

Defined cases: null text has no lines and an empty body; empty lines never link;
a null ``conv_id`` is a conversation of its own, a null ``turn`` comes first in it;
rows with equal (conv_id, turn) are all kept, equal ones in the order of role and
body; an "On ... wrote:" line right before a quote belongs to it; no rows give no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import Scratch, any_rows, pick, ranked

#: A quote mark at a line's start, and the line that introduces a quote.
MARKS = r"^[ \t]*(>[ \t]?)+"
INTRO = r"(?i)^\s*(on .+ wrote|.+ writes|.+ a écrit|.+ schrieb):\s*$"


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, MARKS, ""), r"\s+", " ")))


def parse(messages: DataFrame) -> DataFrame:
    """messages (conv_id, turn, role, text) -> the same with ``lines``: array of (text, level), quote
    introductions lifted to level 1, and ``body``: the own lines."""
    raw = F.split(F.coalesce("text", F.lit("")), "\r?\n", -1)
    lines = F.transform(raw, lambda x: F.struct(x.alias("text"), _level(x).alias("level")))
    out = messages.withColumn("lines", lines)
    lifted = F.transform(F.col("lines"), lambda x, i: F.struct(x["text"].alias("text"), F.when((x["level"] == 0) & x["text"].rlike(INTRO) & (F.coalesce(F.get(F.col("lines"), i + 1)["level"], F.lit(0)) > 0), F.lit(-1)).otherwise(x["level"]).alias("level")))
    out = out.withColumn("lines", F.when(F.exists("lines", lambda x: x["level"] > 0), lifted).otherwise(F.col("lines")))
    body = F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["text"]), "\n")
    return out.withColumn("body", F.regexp_replace(F.regexp_replace(body, r"^(\s*\n)+", ""), r"\s+$", ""))


def links(spark: SparkSession, parsed: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(passages, parents): every linked quote (conv, turn, level, origin, lines, chars), and the message answered."""
    each = parsed.select("conv", "turn", F.explode("lines").alias("l")).select("conv", "turn", F.col("l.level").alias("level"), normal(F.col("l.text")).alias("line")).where("line <> ''")
    key = [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2")]
    quoted = scratch.save(each.where("level > 0").select("conv", "turn", "level", *key, F.length("line").alias("chars")), "quoted")
    wanted = scratch.save(quoted.select("conv", "h1", "h2").distinct(), "wanted")
    own = each.where("level = 0").select("conv", "turn", *key).join(wanted, ["conv", "h1", "h2"], "left_semi")
    origin = scratch.save(own.groupBy("conv", "h1", "h2").agg(F.min("turn").alias("origin")), "origin")
    passages = quoted.join(origin, ["conv", "h1", "h2"]).where("origin < turn").groupBy("conv", "turn", "level", "origin").agg(F.count(F.lit(1)).alias("lines"), F.sum("chars").alias("chars"))
    passages = scratch.save(passages, "passages")
    parents = passages.where("level = 1").groupBy("conv", "turn").agg(F.max(F.struct("chars", "origin")).alias("best")).select("conv", "turn", F.col("best.origin").alias("parent"))
    return passages, scratch.save(parents, "parents")


def roots(spark: SparkSession, parents: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, turn, root) of all answers, by pointer doubling: each round halves the way that is left."""
    cur, i = parents.select("conv", "turn", F.col("parent").alias("root")), 0
    while True:
        up = cur.select("conv", F.col("turn").alias("root"), F.col("root").alias("above"))
        nxt = scratch.save(cur.join(up, ["conv", "root"], "left").select("conv", "turn", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), f"roots{i}")
        cur, i = nxt.drop("moved"), i + 1
        if not any_rows(nxt.where("moved")):
            return cur


def conversations(spark: SparkSession, messages: DataFrame, scratch: Scratch | None = None, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, position, turn, role, text (without quotes), reply_to, thread (the root's turn), n_quoted_lines, n_linked_lines."""
    scratch = scratch or Scratch(spark, "quotes")
    base = pick(messages, conv_id=conv_id, turn=turn, role=role, text=text)
    # joins on plain keys: a null id or turn gets a place of its own
    base = base.select(F.struct(F.col("conv_id").isNotNull().alias("named"), F.coalesce("conv_id", F.lit(0).cast("long")).alias("id")).alias("conv"), F.coalesce("turn", F.lit(-(2**63)).cast("long")).alias("turn"), "role", "text")
    parsed = parse(base)
    passages, parents = links(spark, parsed, scratch)
    rooted = scratch.save(roots(spark, parents, scratch).join(parents, ["conv", "turn"]), "rooted") if any_rows(parents) else parents.withColumn("root", F.col("parent"))
    linked = scratch.save(passages.groupBy("conv", "turn").agg(F.sum("lines").alias("n_linked_lines")), "linked")
    flat = parsed.select("conv", "turn", "role", "body", F.size(F.filter("lines", lambda x: x["level"] > 0)).cast("long").alias("n_quoted_lines"))
    out = flat.join(rooted, ["conv", "turn"], "left").join(linked, ["conv", "turn"], "left")
    out = out.select("conv", F.coalesce("root", "turn").alias("thread"), "turn", "role", "body", "parent", "n_quoted_lines", F.coalesce("n_linked_lines", F.lit(0)).alias("n_linked_lines"))
    out = ranked(scratch, out, "ordered", *(F.col(c) for c in ("conv", "thread", "turn", "role", "body")))
    out = scratch.save(out, "numbered")
    first = scratch.save(out.groupBy("conv").agg(F.min("rank").alias("first")), "first")
    turn_of = lambda c: F.when(F.col(c) != -(2**63), F.col(c))
    return out.join(first, "conv").select(F.when(F.col("conv.named"), F.col("conv.id")).alias("conv_id"), (F.col("rank") - F.col("first")).alias("position"), turn_of("turn").alias("turn"), "role", F.col("body").alias("text"), turn_of("parent").alias("reply_to"), turn_of("thread").alias("thread"), "n_quoted_lines", "n_linked_lines")
