"""Line deduplication with a suffix array over line ids (DataFrame functions only).

A document is its sequence of lines that hold a word; a line's id is a hash of its
text.  Prefix doubling names the first 1, 2, 4, ... lines of every suffix: the name
of 2m lines is the rank of (name of the first m, name of the next m) among all such
pairs in sorted order, so names of one length order the suffixes.  Suffixes with
one name are an interval of the suffix array with longest common prefix of at least
that many lines.  A suffix that shares its name with no other one is left out of
further rounds; nothing can be repeated behind it.

A run of ``min_lines`` lines or more that also starts earlier (by doc_id, then line)
is repeated; later copies are deleted.  ``runs`` gives the maximal ones: a suffix's
match is the longest one with any earlier suffix.  It starts as the suffix's longest
interval and grows by binary descent: suffixes with the same first lines are split by
the name of their next 2**j lines, and all but the first of those that share it go on.
A match that lies inside the one a line above is left out.

Each pair of names is one row after a partial aggregate, so a line that a third of
all documents hold is counted in every task before it moves, and joins with the
stored name tables are split by the adaptive skew join.

Defined cases: null or blank texts have no lines; blank lines are kept and stand for
nothing; a null ``doc_id`` comes before all others; rows with equal doc_id and text
are one document (no copy of itself); rows with equal doc_id and another text follow
in the order of a hash of the text; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import Scratch, any_rows, apart, let, pick, shuffle_partitions

MIN_LINES = 2
NAMELESS = -(2**63)
_AT = ["d", "t", "i"]
_CLASS = ["fd", "ft", "fi", "n"]


def line_ids(docs: DataFrame) -> DataFrame:
    """(d, t, i, id) of the lines with a word, numbered without the blank ones; ``docs`` has d, t, text."""
    kept = F.filter(F.split(F.coalesce("text", F.lit("")), "\n", -1), _has_word)
    ids = F.transform(kept, lambda x: F.xxhash64(x))
    return docs.select("d", "t", F.posexplode(ids).alias("i", "id"))


def first_round(lines: DataFrame, scratch: Scratch) -> DataFrame:
    """(d, t, i, name) of the lines that occur at two places or more."""
    names = lines.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    return scratch.save(lines.join(names, "id").select(*_AT, F.col("id").alias("name")), "level0")


def double(scratch: Scratch, level: DataFrame, step: int, tag: str) -> DataFrame:
    """Names of ``step`` more lines: pairs (name at i, name at i + step) that occur twice or more, ranked in order.

    One job: ranges of distinct sorted pairs number the same rows alike if a task runs again."""
    ahead = level.select("d", "t", (F.col("i") - step).alias("i"), F.col("name").alias("next"))
    pairs = level.join(ahead, _AT).select(*_AT, "name", "next")
    twice = pairs.groupBy("name", "next").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name", "next")
    n = shuffle_partitions(scratch.spark)
    ranks = twice.repartitionByRange(n, "name", "next").sortWithinPartitions("name", "next").withColumn("rank", F.monotonically_increasing_id())
    return scratch.save(pairs.join(ranks, ["name", "next"]).select(*_AT, F.col("rank").alias("name")), f"level{tag}")


def later(level: DataFrame, *by: str) -> DataFrame:
    """(by, d, t, i, fd, ft, fi): suffixes that are not the first of their interval, with that first."""
    first = level.groupBy(*by, "name").agg(F.min(F.struct(*_AT)).alias("f"))
    return level.join(first, [*by, "name"]).where(F.struct(*_AT) != F.col("f")).select(*by, *_AT, F.col("f.d").alias("fd"), F.col("f.t").alias("ft"), F.col("f.i").alias("fi"))


class Suffixes:
    """The rounds, stored; levels[k] names the first 2**k lines."""

    def __init__(self, spark: SparkSession, docs: DataFrame, scratch: Scratch | None = None, doc_id: str = "doc_id", text: str = "text"):
        self.scratch = scratch or Scratch(spark, "suffixes")
        self.docs = pick(docs, doc_id=doc_id, text=text).select(F.coalesce("doc_id", F.lit(NAMELESS).cast("long")).alias("d"), F.xxhash64("text").alias("t"), "text")
        lines = line_ids(self.docs).distinct()  # equal rows are one document
        self.levels = [first_round(self.scratch.save(lines, "lines"), self.scratch)]
        while any_rows(self.levels[-1]):
            k = len(self.levels)
            self.levels.append(double(self.scratch, self.levels[-1], 1 << (k - 1), str(k)))
        self.levels.pop()
        self.tops: dict[int, DataFrame] = {}

    def longest(self, low: int) -> DataFrame:
        """(d, t, i, k, fd, ft, fi): the longest interval (2**k lines, k >= low) of each suffix that is not its first.

        A suffix that follows another in one interval does so in all shorter ones, so the largest k is taken."""
        if low not in self.tops:
            every = reduce(DataFrame.unionAll, [x.withColumn("k", F.lit(k)) for k, x in enumerate(self.levels) if k >= low])
            best = later(every, "k").groupBy(*_AT).agg(F.max(F.struct("k", "fd", "ft", "fi")).alias("m"))
            self.tops[low] = self.scratch.save(best.select(*_AT, "m.*"), f"longest{low}")
        return self.tops[low]

    def deleted(self, min_lines: int = MIN_LINES) -> DataFrame:
        """(d, t, i) of the lines that go: all lines of later copies of a run of ``min_lines``; a line may come more than once."""
        k = min_lines.bit_length() - 1
        if k >= len(self.levels):
            return self.scratch.spark.createDataFrame([], "d long, t long, i int")
        if min_lines > 1 << k:  # the first 2**k and the last 2**k lines, which overlap, name the run
            rest = later(double(self.scratch, self.levels[k], min_lines - (1 << k), f"run{min_lines}"))
        else:
            rest = self.longest(k)
        return rest.select("d", "t", F.explode(F.sequence(F.col("i"), F.col("i") + (min_lines - 1))).alias("i"))

    def runs(self, min_lines: int = MIN_LINES) -> DataFrame:
        """(d, t, i, fd, ft, fi, n): maximal repeated runs of n >= min_lines lines, each with its source."""
        low = min_lines.bit_length() - 1
        if low >= len(self.levels):
            return self.scratch.spark.createDataFrame([], "d long, t long, i int, fd long, ft long, fi int, n int")
        whole, found = self.ends(self.longest(low)), None
        for j in range(len(self.levels) - 2, -1, -1):
            started = whole.where(F.col("k") == j + 1).drop("k").withColumn("n", F.lit(2 << j))
            found = self.grow(started if found is None else found.unionAll(started), j)
        shortest = whole.where("k = 0").drop("k").withColumn("n", F.lit(1))
        found = shortest if found is None else found.unionAll(shortest)
        # No match ends before that of the line above it, so of one end the first is the longest.
        first = found.where(F.col("n") >= min_lines).groupBy("d", "t", (F.col("i") + F.col("n")).alias("end")).agg(F.min(F.struct("i", *_CLASS)).alias("m"))
        return first.select("d", "t", "m.*")

    def ends(self, top: DataFrame) -> DataFrame:
        """``top`` without the intervals whose members all follow one and the same line: whatever
        their suffixes match, the suffixes one line above match too."""
        source = ["k", "fd", "ft", "fi"]
        firsts = top.select(*source).distinct().select(F.col("fd").alias("d"), F.col("ft").alias("t"), F.col("fi").alias("i"), *source)
        above = self.levels[0].select("d", "t", (F.col("i") + 1).alias("i"), F.col("name").alias("above"))
        by = top.select(*_AT, *source).unionAll(firsts).join(above, _AT, "left").groupBy(*source)
        by = by.agg(F.min("above").alias("lo"), F.max("above").alias("hi"), F.count("above").alias("known"), F.count(F.lit(1)).alias("members"))
        return self.scratch.save(top.join(by.where("known < members OR lo < hi").select(*source), source, "left_semi").select(*_AT, *source), "ends")

    def grow(self, found: DataFrame, j: int) -> DataFrame:
        """(d, t, i, fd, ft, fi, n): 2**j lines more for suffixes of which an earlier one has them as well.

        A class is all suffixes of ``found`` with one (fd, ft, fi, n), and that source, the first place of
        their n lines.  Of members that go on alike the first stays and is the source of the others'
        class, so each class holds an earlier suffix for any longer match of its members."""
        sources = found.select(*_CLASS).distinct().select(F.col("fd").alias("d"), F.col("ft").alias("t"), F.col("fi").alias("i"), *_CLASS, F.lit(False).alias("asks"))
        members = found.select(*_AT, *_CLASS, F.lit(True).alias("asks")).unionAll(sources).withColumn("p", F.col("i") + F.col("n"))
        names = self.levels[j].select("d", "t", F.col("i").alias("p"), "name")
        members = self.scratch.save(members.join(names, ["d", "t", "p"], "left").drop("p"), f"members{j}")
        firsts = members.where("name IS NOT NULL").groupBy(*_CLASS, "name").agg(F.min(F.struct(*_AT)).alias("f"))
        named = members.where("asks AND name IS NOT NULL").join(firsts, [*_CLASS, "name"])
        goes = F.struct(*_AT) != F.col("f")
        place = [F.when(goes, F.col(f"f.{x}")).otherwise(F.col(f"f{x}")).alias(f"f{x}") for x in _AT]
        grown = named.select(*_AT, *place, (F.col("n") + F.when(goes, 1 << j).otherwise(0)).alias("n"))
        return members.where("asks AND name IS NULL").select(*_AT, *_CLASS).unionAll(grown)


def dedup_lines(spark: SparkSession, docs: DataFrame, min_lines: int = MIN_LINES, scratch: Scratch | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed, n_runs, longest_run, kept_text for every row."""
    s = Suffixes(spark, docs, scratch, doc_id, text)
    gone = s.deleted(min_lines).groupBy("d", "t").agg(F.collect_set("i").alias("gone"))
    runs = s.runs(min_lines).groupBy("d", "t").agg(F.count(F.lit(1)).alias("n_runs"), F.max("n").alias("longest_run"))
    gone = s.scratch.save(gone.join(runs, ["d", "t"], "left"), "gone")
    # Only texts that lose lines move; the join is a merge at every size.
    near, rest = apart(s.docs, gone, "d", "t")
    out = near.join(gone.hint("merge"), ["d", "t"], "left").unionByName(rest, allowMissingColumns=True).withColumn("parts", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    n_lines = F.size(F.filter("parts", _has_word)).cast("long")
    left = F.when(F.col("gone").isNull(), F.col("text")).otherwise(_without(F.col("parts"), F.col("gone")))
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select(F.when(F.col("d") != NAMELESS, F.col("d")).alias("doc_id"), n_lines.alias("n_lines"), number(F.size(F.coalesce("gone", F.array()))).alias("n_removed"), number(F.col("n_runs")).alias("n_runs"), number(F.col("longest_run")).alias("longest_run"), left.alias("kept_text"))


def _has_word(line: Column) -> Column:
    return line.rlike("[^\\x20\\x09-\\x0D]")


def _without(parts: Column, gone: Column) -> Column:
    """The text without the lines numbered in ``gone`` (numbers count lines with a word); linear in the lines."""
    every = F.sequence(F.lit(0), F.size(parts) - 1)
    worded = F.filter(every, lambda i: _has_word(F.get(parts, i)))
    places = let(worded, lambda w: F.transform(gone, lambda g: F.get(w, g)))
    return F.array_join(F.transform(F.array_except(every, places), lambda i: F.get(parts, i)), "\n")
