"""Conversation structure repair: cheapest edits by a persistent audit DP.

A conversation is repaired until its role initials read ``(s?(ua)+)?``.  Edits of a row, and
their letters: Keep 0 (a truncated row 5), Rerole to user or assistant 1 (truncated 6),
Delete 2 (the only edit of a blank or duplicate row), Insert an empty user or assistant row 5.
Among cheapest edit sequences the audit, the letters in order, is the ASCII-least.

The DP walks the rows with four states (nothing yet, after ``s``, after ``u``, after a whole
``ua``).  A state's best edits are a node of a shared tree: a node holds its letter, its parent,
binary-lifting ancestors and the rolling hash of its whole prefix, so a step adds a constant
number of nodes and copies no prefix.  Two prefixes of equal cost are compared at the letter
after their longest common prefix, found by lifting both while their hashes differ; the
prefix is verified by the shared node it must end in, and a hash collision falls back to the
letters themselves.

Insertions are placed right before the row they precede (never before a deleted row: ``DI`` is
less than ``ID`` and leaves the same rows) or after the last row.  The prefixes of the states after a row
then hold equally many row letters and end in one, so none begins another, and their order
is settled: a stretch of rows is described by its cheapest cost from each state to each
state and the order of those audits, 16 numbers each, and stretches chain exactly.

Spark sorts all rows by conversation and turn over range partitions; tasks cut them into
stretches of at most ``CHUNK_ROWS`` rows, run the DP on each from every state it can start in,
and write stretch and numbers to the shared folder.  A conversation's numbers, one line per
stretch, are then chained and traced back in one task, which streams the stretches after them.
A conversation that holds a third of all rows is thus worked on by many tasks; only its
chaining and its SHA-256, which is sequential by definition, are one task's, in memory of a
few bytes per stretch besides the audit itself.

Equal rows of one turn are counted first and stand as one row with a number; all but the first are deleted
as duplicates.  Duplicates of other turns are found by the first turn of each (role, text).
Rows of one turn come by role, then by the SHA-256 of the text.

Defined cases: a null role or text is one space (its row is blank if the text is); null ids are one
conversation; null turns come first and do not count for gaps; roles count by their first
character, an empty role has none and stays illegal until it is reroled; an id without rows
(all dropped) has zeros, an empty audit and the hash of the empty string; no rows give no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterator
from functools import cmp_to_key
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import Scratch, pick, shuffle_partitions

CHUNK_ROWS, CHUNK_BYTES = 256, 256 << 10
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
START, SYSTEM, USER, WHOLE = range(4)
WHITE = "\t\n\v\f\r "
NONE = -1
_MOD, _BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E681 % ((1 << 61) - 1)


class Trail:
    """Edit prefixes as linked nodes; node 0 is the empty prefix."""

    def __init__(self) -> None:
        self.letter, self.depth, self.hash, self.up = [""], [0], [0], [[0]]

    def add(self, node: int, letter: str) -> int:
        lifts, k, at = [node], 0, node
        while True:
            above = self.up[at]
            if k >= len(above) or above[k] == 0:
                break
            at = above[k]
            lifts.append(at)
            k += 1
        self.up.append(lifts)
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * _BASE + ord(letter)) % _MOD)
        return len(self.letter) - 1

    def ancestor(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            gap, lifts = self.depth[node] - depth, self.up[node]
            node = lifts[min(gap.bit_length() - 1, len(lifts) - 1)]
        return node

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def compare(self, a: int, b: int) -> int:
        """-1, 0 or 1 as the prefix of ``a`` is less than, equal to or greater than that of ``b``."""
        if a == b:
            return 0
        n = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, n), self.ancestor(b, n)
        if self.hash[x] == self.hash[y]:
            if x == y:  # one begins the other
                return -1 if self.depth[a] < self.depth[b] else 1
            return self._letters(a, b)
        # lift both while they differ: x and y end as the nodes of the first different letter
        for k in range(max(len(self.up[x]), len(self.up[y])) - 1, -1, -1):
            if k < len(self.up[x]) and k < len(self.up[y]):
                p, q = self.up[x][k], self.up[y][k]
                if self.hash[p] != self.hash[q]:
                    x, y = p, q
        if self.up[x][0] == self.up[y][0] and self.letter[x] != self.letter[y]:
            return -1 if self.letter[x] < self.letter[y] else 1
        return self._letters(a, b)

    def _letters(self, a: int, b: int) -> int:
        s, t = self.text(a), self.text(b)
        return (s > t) - (s < t)


State = list  # four of (cost, node) or None


def step(trail: Trail, cur: State, forced: bool, cut: bool, initial: str, copies: int) -> State:
    """The best prefixes after one more row (and its ``copies`` - 1 equal rows, which are deleted)."""
    more = DELETE * (copies - 1)
    new: State = [c and (c[0] + DELETE + more, c[1], "D") for c in cur]
    if not forced:
        stays = (TRUNCATED if cut else 0) + more
        as_user = (KEEP, "K") if initial == "u" else (REROLE, "R")
        as_assistant = (KEEP, "K") if initial == "a" else (REROLE, "R")
        inserted: dict[int, int] = {}

        def offer(source: int, target: int, price: int, letter: str, insert: bool = False) -> None:
            if cur[source] is None:
                return
            cost, node = cur[source]
            cost += price + stays + (INSERT if insert else 0)
            best = new[target]
            if best and best[0] < cost:
                return
            if insert:
                node = inserted[source] if source in inserted else inserted.setdefault(source, trail.add(node, "I"))
            if best and best[0] == cost:
                mine, other = trail.add(node, letter), best[1] if not best[2] else trail.add(best[1], best[2])
                new[target] = (cost, mine if trail.compare(mine, other) < 0 else other, "")
            else:
                new[target] = (cost, node, letter)

        if initial == "s":
            offer(START, SYSTEM, KEEP, "K")
        for source in (START, SYSTEM, WHOLE):
            offer(source, USER, *as_user)
            offer(source, WHOLE, *as_assistant, insert=True)
        offer(USER, WHOLE, *as_assistant)
        offer(USER, USER, *as_user, insert=True)
    return [c and (c[0], trail.add(c[1], c[2]) if c[2] else c[1]) for c in new]


def order(trail: Trail, cur: State) -> list[int]:
    """Each state's place among the audits of all states."""
    alive = sorted((s for s in range(4) if cur[s]), key=cmp_to_key(lambda a, b: trail.compare(cur[a][1], cur[b][1])))
    return [alive.index(s) if s in alive else NONE for s in range(4)]


def stretch(rows: list[tuple[bool, bool, str, int]], starts: Any) -> tuple[list[int], list[int], list[str]]:
    """Cost, order and audit (one letter a row, and insertions) from each state to each state."""
    costs, ranks, audits = [NONE] * 16, [NONE] * 16, [""] * 16
    for s in starts:
        trail = Trail()
        cur: State = [None] * 4
        cur[s] = (0, 0)
        for row in rows:
            cur = step(trail, cur, *row)
        ranks[4 * s : 4 * s + 4] = order(trail, cur)
        for t in range(4):
            if cur[t]:
                costs[4 * s + t], audits[4 * s + t] = cur[t][0], trail.text(cur[t][1])
    return costs, ranks, audits


class Chain:
    """Stretches of one conversation in order: forward costs, then the states on the best way."""

    def __init__(self) -> None:
        self.cost, self.rank = [0, None, None, None], [0, 0, 0, 0]
        self.back = array("b")

    def add(self, costs: list[int], ranks: list[int]) -> None:
        ways = []
        for t in range(4):
            ways.append(min(((self.cost[m] + costs[4 * m + t], self.rank[m], m) for m in range(4) if self.cost[m] is not None and costs[4 * m + t] != NONE), default=None))
        self.back.extend(w[2] if w else NONE for w in ways)
        self.cost = [w and w[0] for w in ways]
        places = sorted((w[1], ranks[4 * w[2] + t], t) for t, w in enumerate(ways) if w)
        self.rank = [0] * 4
        for place, (_, _, t) in enumerate(places):
            self.rank[t] = place

    def close(self) -> tuple[int, bool, array]:
        """(cost, whether an assistant row is inserted at the end, states before and after the stretches)."""
        ends = [(self.cost[t] + (INSERT if t == USER else 0), self.rank[t], t) for t in (START, USER, WHOLE) if self.cost[t] is not None]
        cost, _, t = min(ends)
        states = array("b", [t])
        for i in range(len(self.back) // 4 - 1, -1, -1):
            states.append(self.back[4 * i + states[-1]])
        states.reverse()
        return cost, t == USER, states


def replay(state: int, audit: str, roles: list[str], texts: list[str], copies: list[int]) -> Iterator[tuple[str, str | None, str]]:
    """(edit letters, role, text) of each row of a stretch and each insertion; a deleted row has no role."""
    i = 0
    for x in audit:
        if x == "I":
            yield "I", "assistant" if state == USER else "user", ""
            state = WHOLE if state == USER else USER
            continue
        again = "D" * (copies[i] - 1)
        if x == "D":
            yield "D" + again, None, ""
        elif x == "R":
            yield "R" + again, "assistant" if state == USER else "user", texts[i]
            state = WHOLE if state == USER else USER
        else:
            yield "K" + again, roles[i], texts[i]
            state = {"s": SYSTEM, "u": USER, "a": WHOLE}[roles[i][0]]
        i += 1


LEGAL = ("su", "ua", "au")
_CONV = pa.struct([("named", pa.bool_()), ("id", pa.int64())])
_STRETCH = pa.schema([
    ("conv", _CONV), ("part", pa.int32()), ("seq", pa.int64()), ("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int32())), ("audits", pa.list_(pa.string())),
    ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("copies", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
    ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("first_initial", pa.string()), ("last_initial", pa.string())])
STRETCHES = ("conv struct<named:boolean,id:long>, part int, seq long, costs array<long>, ranks array<int>, audits array<string>, roles array<string>, texts array<string>, copies array<long>, "
             "counts array<long>, first_turn long, last_turn long, first_initial string, last_initial string")  # fmt: skip


class _Open:
    """The stretch that a task is filling."""

    def __init__(self, conv: dict, first: bool):
        self.conv, self.first, self.rows, self.bytes = conv, first, [], 0

    def add(self, turn: int | None, role: str, text: str, copies: int, blank: bool, cut: bool, earliest: bool) -> None:
        self.rows.append((turn, role, text, copies, blank, cut, earliest))
        self.bytes += len(text)

    def record(self, part: int, seq: int) -> dict:
        dp, texts, blanks, doubles, cuts, illegal, turns = [], [], 0, 0, 0, 0, []
        last = None
        for turn, role, text, copies, blank, cut, earliest in self.rows:
            forced = blank or not earliest
            blanks += copies * blank
            doubles += 0 if blank else copies - earliest
            cuts += cut and not forced
            initial = role[:1]
            illegal += copies - 1 + (last is not None and last + initial not in LEGAL)
            last = initial
            if turn is not None and (not turns or turns[-1] != turn):
                turns.append(turn)
            dp.append((forced, cut, initial, copies))
            texts.append("" if forced else text)
        costs, ranks, audits = stretch(dp, (START,) if self.first else range(4))
        return {"conv": self.conv, "part": part, "seq": seq, "costs": costs, "ranks": ranks, "audits": audits, "roles": [r[1] for r in self.rows], "texts": texts, "copies": [r[3] for r in self.rows],
                "counts": [blanks, doubles, cuts, illegal, len(turns)], "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None, "first_initial": dp[0][2], "last_initial": last}


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, seq, open_, done, size = TaskContext.get().partitionId(), 0, None, [], 0
    leading = True  # the task's first conversation may have begun in the partition before

    def close() -> None:
        nonlocal seq, size, open_
        done.append(open_.record(part, seq))
        size += open_.bytes
        seq += 1

    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            for r in batch.slice(lo, 1024).to_pylist():
                if open_ is None:
                    open_ = _Open(r["conv"], False)
                elif open_.conv != r["conv"]:
                    close()
                    leading = False
                    open_ = _Open(r["conv"], True)
                elif len(open_.rows) >= CHUNK_ROWS or open_.bytes >= CHUNK_BYTES:
                    close()
                    open_ = _Open(r["conv"], False)
                open_.add(r["turn"]["turn"] if r["turn"]["given"] else None, r["role"], r["text"], r["copies"], r["blank"], r["cut"], r["earliest"])
            if len(done) >= 512 or size >= 4 << 20:
                yield pa.RecordBatch.from_pylist(done, _STRETCH)
                done, size = [], 0
    if open_ is not None:
        close()
    if done:
        yield pa.RecordBatch.from_pylist(done, _STRETCH)


def slots(turns: DataFrame) -> DataFrame:
    """One row per conversation, turn, role and text, with its number of copies and its faults."""
    conv = F.struct(F.col("conv_id").isNotNull().alias("named"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0).cast("long")).alias("id"))
    turn = F.struct(F.col("turn").isNotNull().alias("given"), F.coalesce(F.col("turn").cast("long"), F.lit(0).cast("long")).alias("turn"))
    text = F.coalesce("text", F.lit(" "))
    rows = turns.select(conv.alias("conv"), turn.alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.sha2(text, 256).alias("h"), text.alias("text"), "copies")
    one = rows.groupBy("conv", "turn", "role", "h").agg(F.sum("copies").alias("copies"), F.first("text").alias("text"))
    body = F.trim("text", F.lit(WHITE))
    return one.select("*", (body == "").alias("blank"), (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("cut"))


def stretches(spark: SparkSession, turns: DataFrame, scratch: Scratch) -> DataFrame:
    """All conversations as written stretches with their DP numbers."""
    rows = scratch.save(slots(turns), "slots")
    first = rows.groupBy("conv", "role", "h").agg(F.min("turn").alias("turn")).withColumn("earliest", F.lit(True))
    flagged = rows.join(first, ["conv", "turn", "role", "h"], "left").withColumn("earliest", F.coalesce("earliest", F.lit(False)))
    key = ["conv", "turn", "role", "h"]
    flagged = flagged.repartitionByRange(shuffle_partitions(spark), *key).sortWithinPartitions(*key)
    out = scratch.save(flagged.select("conv", "turn", "role", "text", "copies", "blank", "cut", "earliest").mapInArrow(_stretches, STRETCHES), "stretches")
    scratch.drop("slots")
    return out


_NUMBERS = ["costs", "ranks", "counts", "first_turn", "last_turn", "first_initial", "last_initial"]
_BODY = ["audits", "roles", "texts", "copies"]


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, dict, Iterator[tuple[str, str | None, str]]]]:
    """(conversation, totals, its edits in order) of each conversation: its numbers come first, then its stretches."""

    def rows() -> Iterator[dict]:
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                yield from b.slice(lo, 64).to_pylist()

    todo = rows()
    row = next(todo, None)
    while row is not None:
        conv, chain = row["conv"], Chain()
        counts, low, high, before_turn, before = [0] * 5, None, None, None, None
        while row is not None and row["kind"] == 0 and row["conv"] == conv:
            chain.add(row["costs"], row["ranks"])
            counts = [a + b for a, b in zip(counts, row["counts"])]
            counts[3] += before is not None and before + row["first_initial"] not in LEGAL
            counts[4] -= before_turn is not None and before_turn == row["first_turn"]
            before = row["last_initial"]
            if row["last_turn"] is not None:
                low, high, before_turn = row["first_turn"] if low is None else low, row["last_turn"], row["last_turn"]
            row = next(todo, None)
        cost, insert, states = chain.close()
        gaps = 0 if low is None else min(high - low + 1 - counts[4], (1 << 63) - 1)
        totals = {"gaps": gaps, "blank": counts[0], "duplicate": counts[1], "truncated": counts[2], "illegal": counts[3], "cost": cost}

        def edits() -> Iterator[tuple[str, str | None, str]]:
            nonlocal row
            i = 0
            while row is not None and row["conv"] == conv:
                a, b = states[i], states[i + 1]
                yield from replay(a, row["audits"][4 * a + b], row["roles"], row["texts"], row["copies"])
                i += 1
                row = next(todo, None)
            if insert:
                yield "I", "assistant", ""

        yield conv, totals, edits()


def _streamed(spark: SparkSession, written: DataFrame) -> DataFrame:
    head = written.select("conv", F.lit(0).alias("kind"), "part", "seq", *_NUMBERS, *[F.lit(None).cast(written.schema[c].dataType).alias(c) for c in _BODY])
    body = written.select("conv", F.lit(1).alias("kind"), "part", "seq", *[F.lit(None).cast(written.schema[c].dataType).alias(c) for c in _NUMBERS], *_BODY)
    both = head.unionAll(body)
    return both.repartition(shuffle_partitions(spark), "conv").sortWithinPartitions("conv", "kind", "part", "seq")


_AUDIT = pa.schema([("conv", _CONV), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
AUDITS = "conv struct<named:boolean,id:long>, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _in_batches(records: Iterator[dict], schema: pa.Schema, size: Callable[[dict], int]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for r in records:
        held.append(r)
        n += size(r)
        if n >= 4 << 20 or len(held) >= 4096:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def each() -> Iterator[dict]:
        for conv, totals, edits in _conversations(batches):
            digest, letters, first = hashlib.sha256(), [], True
            for letter, role, text in edits:
                letters.append(letter)
                if role is not None:
                    digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                    first = False
            yield {"conv": conv, **totals, "audit": "".join(letters), "repaired_sha256": digest.hexdigest()}

    return _in_batches(each(), _AUDIT, lambda r: len(r["audit"]))


_TURN = pa.schema([("conv", _CONV), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def each() -> Iterator[dict]:
        for conv, _, edits in _conversations(batches):
            at = 0
            for letter, role, text in edits:
                if role is not None:
                    yield {"conv": conv, "position": at, "role": role, "text": text, "edit": letter[0]}
                    at += 1

    return _in_batches(each(), _TURN, lambda r: len(r["text"]))


def _id() -> Column:
    return F.when(F.col("conv.named"), F.col("conv.id")).alias("conv_id")


def counted(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Plain turn rows as the repair reads them."""
    return pick(turns, conv_id=conv_id, turn=turn, role=role, text=text).withColumn("copies", F.lit(1).cast("long"))


def damage(turns: DataFrame) -> DataFrame:
    """``counted`` rows with the faults that crc32(``conv_id:turn``) % 20 deals out (a null: one space)."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(name) % 20
    text = F.coalesce("text", F.lit(" "))
    return turns.withColumn("kind", kind).where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(F.col("kind") == 3, F.col("copies") * 2).otherwise(F.col("copies")).alias("copies"))


def repaired_turns(spark: SparkSession, turns: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """conv_id, position, role, text, edit (K, R or I) of every row of the repaired conversations; ``turns`` as from ``counted``."""
    scratch = scratch or Scratch(spark, "repair")
    out = _streamed(spark, stretches(spark, turns, scratch)).mapInArrow(_turns, "conv struct<named:boolean,id:long>, position long, role string, text string, edit string")
    return out.select(_id(), "position", "role", "text", "edit")


def audits(spark: SparkSession, turns: DataFrame, everyone: DataFrame | None = None, scratch: Scratch | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of every
    conversation of ``everyone`` (its ``conv_id`` column; ``turns`` by default); ``turns`` as from ``counted``."""
    scratch = scratch or Scratch(spark, "repair")
    found = scratch.save(_streamed(spark, stretches(spark, turns, scratch)).mapInArrow(_audits, AUDITS), "audits")
    ids = (turns if everyone is None else everyone).select(F.col("conv_id").alias("of")).distinct()
    found = found.select(_id(), *[c for c in found.columns if c != "conv"])
    out = ids.join(found, ids["of"].eqNullSafe(found["conv_id"]), "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("of").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
