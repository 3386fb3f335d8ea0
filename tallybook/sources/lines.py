"""CSV files as physical lines and records, read in parallel blocks at every file size.

Spark's text source cuts each file into blocks (one task each) and, with ``lineSep`` ``\\n``, hands
out the raw bytes of every physical line.  A line's number is exact without a sort: inside a block
the row ids count up, so it is the lines of the file's earlier blocks plus the row's distance from
the block's first row.

One pass reduces every block to a few numbers, for the two ways a block can begin, outside and
inside a quoted field:

* its lines and bytes, and whether they are valid UTF-8 (a line feed is never part of another
  character, so a file is valid if all its lines are);
* two 64-bit hashes of its lines in order.  Those of neighbouring blocks combine into the hash of
  both, so the fingerprint depends on the bytes alone, not on where the blocks were cut;
* whether its end lies inside a quoted field, and where the record that is open there began.

Folding the blocks of a file in order gives each block its first line number and its entry state,
and the file its fingerprint.  A line without an odd quote maps each state to itself, so only lines
with one are looked at to find the records of several lines.

Record rules are those of Python's ``csv`` (the ``excel`` dialect): a quote counts at the start of a
field only, ``""`` inside a quoted field is a quote, text after the closing quote belongs to the
field, a record may span lines inside quotes and has the number of its last line, an empty line is
a record of no fields, ``\\r`` before the line feed is dropped, and a quoted field that is never
closed ends with the file.  A file of zero bytes is not listed by Spark's readers and is ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .contracts import CONTRACTS, SourceContract

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:{_QUOTED}"[^,]*+|(?!")[^,]*+)'
#: A line that begins outside (inside) quotes and ends inside a quoted field.
_OPENS = rf"^(?:{_FIELD},)*+{_QUOTED}\z"
_STAYS = rf'^[^"]*+(?:""[^"]*+)*+(?:\z|"[^,]*+,(?:{_FIELD},)*+{_QUOTED}\z)'
#: Length limit of a field, as in Python's csv.
FIELD_LIMIT = 131072
#: Up to so many blocks (a file has at least one) are broadcast to the lines; beyond, lines and blocks are shuffled.
FEW_BLOCKS = 200_000
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15


def glob_to_regex(pattern: str) -> str:
    out = ""
    for ch in pattern:
        out += "[^/]*" if ch == "*" else ("[^/]" if ch == "?" else re.escape(ch))
    return f"^{out}$"


def source_of(name: Column, contracts: dict[str, SourceContract] = CONTRACTS) -> Column:
    expr = None
    for c in contracts.values():
        cond = name.rlike(glob_to_regex(c.pattern))
        expr = F.when(cond, c.table) if expr is None else expr.when(cond, c.table)
    return expr


def relative(path: Column, root: str) -> Column:
    below = root.rstrip("/").split("://")[-1] + "/"
    at = F.instr(path, below)   # no pattern: this runs for every line
    return F.when(at > 0, F.substring(path, at + len(below), F.lit(2**31 - 1) - at - len(below))).otherwise(path)


def fields(record: Column) -> Column:
    """The fields of one record (without its line end) as ``csv`` reads them; an empty record has none."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(rf'(?s),((?:{_QUOTED}(?:"|\z))?+[^,]*+)'), F.lit(1))

    def value(f: Column) -> Column:
        inner = F.regexp_extract(f, rf'(?s)^"([^"]*+(?:""[^"]*+)*+)(?:"|\z)(.*)\z', 1)
        after = F.regexp_extract(f, rf'(?s)^{_QUOTED}(?:"|\z)(.*)\z', 1)
        return F.when(f.startswith('"'), F.concat(F.replace(inner, F.lit('""'), F.lit('"')), after)).otherwise(f)

    many = F.when(record.contains('"'), F.transform(raw, value)).otherwise(F.split(record, ",", -1))
    return F.when(record == "", F.array().cast("array<string>")).otherwise(many)


def bare_return(record: Column) -> Column:
    """Whether a record holds a carriage return outside quotes (``csv`` refuses it)."""
    return record.contains("\r") & F.regexp_replace(record, rf'(^|,){_QUOTED}(?:"|\z)', "$1q").contains("\r")


def chomp(line: Column) -> Column:
    return F.when(line.endswith("\r"), F.regexp_replace(line, r"\r++\z", "")).otherwise(line)


def scan(spark: SparkSession, root: str, paths: list[str] | None = None, contracts: dict[str, SourceContract] = CONTRACTS) -> DataFrame:
    """Every physical line of the files under ``root`` (or of ``paths``) that belong to a contract."""
    reader = spark.read.option("lineSep", "\n")
    text = reader.text(paths) if paths is not None else reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").text(root)
    return text.select(
        relative(F.col("_metadata.file_path"), root).alias("file_name"),
        F.col("_metadata.file_block_start").alias("blk"), F.col("_metadata.file_size").alias("size_bytes"),
        F.col("_metadata.file_modification_time").alias("modified_at"), F.monotonically_increasing_id().alias("mid"), F.col("value").alias("line"),
    ).withColumn("source", source_of(F.col("file_name"), contracts)).where("source IS NOT NULL")


def quoting(line: Column) -> tuple[Column, Column]:
    """Whether the text behind the line is inside a quoted field, if the line begins outside / inside one."""
    odd = line.contains('"')
    return F.when(odd, line.rlike(_OPENS)).otherwise(False), F.when(odd, line.rlike(_STAYS)).otherwise(True)


def _is_header(contracts: dict[str, SourceContract]) -> Column:
    expr = F.lit(False)
    for c in contracts.values():
        joined = ",".join(c.header)
        line = chomp(F.col("line"))
        # Few lines begin like a header: the others are not looked at further.
        plain = F.when(line.startswith('"') | line.startswith(c.header[0]), F.translate(line, '"', "") == joined).otherwise(False)
        exact = plain & (~line.contains('"') | (fields(line) == F.array(*map(F.lit, c.header))))
        expr = F.when(F.col("source") == c.table, exact).otherwise(expr)
    return expr


class _Block:
    """Running numbers of one block, for both states it may begin in."""

    def __init__(self, key: tuple, first_mid: int, header_ok: bool, info: tuple):
        self.key, self.info, self.first_mid, self.header_ok = key, info, first_mid, header_ok
        self.lines, self.bytes, self.valid, self.h, self.multi = 0, 0, True, [0, 0], False
        self.state, self.open = [0, 1], [-1, -1]

    def add(self, size: np.ndarray, valid: np.ndarray, leaves: list[np.ndarray], opens: np.ndarray, stays: np.ndarray, powers: np.ndarray) -> None:
        m = len(size)
        self.bytes += int(size.sum())
        self.valid = self.valid and bool(valid.all())
        for i, leaf in enumerate(leaves):
            part = int((leaf * powers[m - 1 :: -1] if m < len(powers) else leaf * powers[::-1]).sum(dtype=np.uint64))
            self.h[i] = (self.h[i] * pow(_BASE, m, 1 << 64) + part) & _MASK
        for i in np.flatnonzero(opens | ~stays).tolist():
            for e in (0, 1):
                after = int(stays[i] if self.state[e] else opens[i])
                if after and not self.state[e]:
                    self.open[e] = self.lines + i
                elif not after:
                    self.open[e] = -1
                self.state[e] = after
        self.multi = self.multi or bool(opens.any())
        self.lines += m

    def row(self) -> tuple:
        return (*self.key, *self.info, self.first_mid, self.lines, self.bytes, self.valid, *[x - (1 << 64) if x >> 63 else x for x in self.h], self.multi, self.header_ok, *self.state, *self.open)


_BLOCK = "file_name string, blk long, size_bytes long, modified_at timestamp, first_mid long, n long, bytes long, valid boolean, h1 long, h2 long, multi boolean, header_ok boolean, s0 int, s1 int, o0 long, o1 long"
_BLOCK_ARROW = pa.schema([("file_name", pa.string()), ("blk", pa.int64()), ("size_bytes", pa.int64()), ("modified_at", pa.timestamp("us", "UTC")), ("first_mid", pa.int64()), ("n", pa.int64()), ("bytes", pa.int64()),
                          ("valid", pa.bool_()), ("h1", pa.int64()), ("h2", pa.int64()), ("multi", pa.bool_()), ("header_ok", pa.bool_()), ("s0", pa.int32()), ("s1", pa.int32()), ("o0", pa.int64()), ("o1", pa.int64())])


def _as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Block rows of a task's lines, which come in file order; no text passes through here."""
    powers = np.ones(1, np.uint64)
    at: _Block | None = None
    done: list[tuple] = []
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        if len(powers) < n:
            powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, _BASE, np.uint64))]) if n > 1 else np.ones(1, np.uint64)
        col = {name: b.column(i) for i, name in enumerate(b.schema.names)}
        names, blk = col["file_name"].dictionary_encode(), col["blk"].to_numpy()
        code = names.indices.to_numpy()
        cuts = [0, *(np.flatnonzero((code[1:] != code[:-1]) | (blk[1:] != blk[:-1])) + 1).tolist(), n]
        size, valid = col["size"].to_numpy(), col["valid"].to_numpy(zero_copy_only=False)
        leaves = [col[h].to_numpy().view(np.uint64) for h in ("h1", "h2")]
        opens, stays = (col[c].to_numpy(zero_copy_only=False) for c in ("opens", "stays"))
        for lo, hi in zip(cuts, cuts[1:]):
            key = (col["file_name"][lo].as_py(), int(blk[lo]))
            if at is None or at.key != key:
                if at is not None:
                    done.append(at.row())
                at = _Block(key, col["mid"][lo].as_py(), col["is_header"][lo].as_py(), (col["size_bytes"][lo].as_py(), col["modified_at"][lo].as_py()))
            at.add(size[lo:hi], valid[lo:hi], [x[lo:hi] for x in leaves], opens[lo:hi], stays[lo:hi], powers)
        if len(done) >= 1000:
            yield _as_batch(done, _BLOCK_ARROW)
            done = []
    if at is not None:
        done.append(at.row())
    if done:
        yield _as_batch(done, _BLOCK_ARROW)


_PLACED = _BLOCK + ", start long, entry int, open_since long, last boolean, lines long, all_bytes long, all_valid boolean, f1 long, f2 long, any_multi boolean, first_ok boolean, exit int"
_PLACED_ARROW = pa.schema([*_BLOCK_ARROW, ("start", pa.int64()), ("entry", pa.int32()), ("open_since", pa.int64()), ("last", pa.bool_()), ("lines", pa.int64()), ("all_bytes", pa.int64()), ("all_valid", pa.bool_()), ("f1", pa.int64()), ("f2", pa.int64()), ("any_multi", pa.bool_()), ("first_ok", pa.bool_()), ("exit", pa.int32())])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by file and place, with their start and entry state; a file's last block has its totals."""
    held: list[tuple] = []
    previous: tuple | None = None
    name, start, entry, since, total, h = None, 0, 0, -1, [0, True, False, False], [0, 0]

    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    def ended() -> tuple:
        return (*previous[:-9], True, start, total[0], total[1], signed(h[0]), signed(h[1]), total[2], total[3], entry)

    for b in batches:
        for r in b.to_pylist():
            if r["file_name"] != name:
                if previous is not None:
                    held.append(ended())
                name, start, entry, since, total, h, previous = r["file_name"], 0, 0, -1, [0, True, False, r["header_ok"]], [0, 0], None
            if previous is not None:
                held.append(previous)
            head = (*[r[c] for c in _BLOCK_ARROW.names], start, entry, since)
            first = r[f"o{entry}"]
            since = (start + first if first >= 0 else since) if r[f"s{entry}"] else -1
            entry = r[f"s{entry}"]
            start += r["n"]
            h = [(x * pow(_BASE, r["n"], 1 << 64) + (r[c] & _MASK)) & _MASK for x, c in zip(h, ("h1", "h2"))]
            total = [total[0] + r["bytes"], total[1] and r["valid"], total[2] or r["multi"], total[3]]
            previous = (*head, False, 0, 0, True, 0, 0, False, False, 0)
            if len(held) >= 1000:
                yield _as_batch(held, _PLACED_ARROW)
                held = []
    if previous is not None:
        held.append(ended())
    if held:
        yield _as_batch(held, _PLACED_ARROW)


_LINE_RUN = pa.schema([("file_name", pa.string()), ("first", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines lo..hi of a block that belong to a record of several lines which began at ``first``.  Each block comes as
    one row with its place, then its lines with an odd quote in order."""
    out: list[tuple] = []
    block: dict | None = None
    state, first, lo = 0, -1, 0

    def ended() -> None:
        if block is not None and state:
            out.append((block["file_name"], first, lo, block["start"] + block["n"] - 1))

    for b in batches:
        for r in b.to_pylist():
            if r["pos"] < 0:
                ended()
                block, state, first, lo = r, r["entry"], r["open_since"], r["start"]
                continue
            after = r["stays"] if state else r["opens"]
            if after and not state:
                first = lo = r["pos"]
            elif state and not after:
                out.append((r["file_name"], first, lo, r["pos"]))
            state = int(after)
        if len(out) >= 1000:
            yield _as_batch(out, _LINE_RUN)
            out = []
    ended()
    if out:
        yield _as_batch(out, _LINE_RUN)


@dataclass
class Files:
    """Lines of some files with their reduced blocks."""

    lines: DataFrame
    blocks: DataFrame
    contracts: dict[str, SourceContract]
    few: bool = False   # whether the rows of the blocks fit a broadcast

    @classmethod
    def read(cls, spark: SparkSession, root: str, paths: list[str] | None = None, contracts: dict[str, SourceContract] = CONTRACTS) -> Files:
        lines = scan(spark, root, paths, contracts)
        opens, stays = quoting(F.col("line"))
        numbers = lines.select(
            "file_name", "blk", "size_bytes", "modified_at", "mid", F.octet_length("line").cast("long").alias("size"), F.is_valid_utf8("line").alias("valid"),
            F.xxhash64(F.lit(1), F.col("line").cast("binary")).alias("h1"), F.xxhash64(F.lit(2), F.col("line").cast("binary")).alias("h2"), opens.alias("opens"), stays.alias("stays"),
            F.when(F.col("blk") == 0, _is_header(contracts)).otherwise(False).alias("is_header"))
        reduced = numbers.mapInArrow(_reduce, _BLOCK)
        placed = reduced.repartition("file_name").sortWithinPartitions("file_name", "blk").mapInArrow(_fold, _PLACED)
        blocks = placed.checkpoint(eager=True)  # one row a block, in the shared folder
        return cls(lines, blocks, contracts, blocks.count() <= FEW_BLOCKS)

    def table(self) -> DataFrame:
        """One row per file: file_name, source, size_bytes, modified_at, lines, fingerprint, valid, header_ok, multi, bom, open_end."""
        spare = F.col("size_bytes") - F.col("all_bytes") - F.col("lines") + 1  # 0 or 1 for a line feed at the end, 3 more for a byte order mark
        return self.blocks.where("last").select(
            "file_name", source_of(F.col("file_name"), self.contracts).alias("source"), "size_bytes", "modified_at", "lines", F.sha2(F.concat_ws(":", "f1", "f2", "lines", "size_bytes", spare), 256).alias("fingerprint"),
            F.col("all_valid").alias("valid"), (F.col("first_ok") & (spare < 3)).alias("header_ok"), F.col("any_multi").alias("multi"), (spare >= 3).alias("bom"),
            F.when(F.col("exit") == 1, spare % 3 == 1).otherwise(False).alias("open_end"))

    def _placed(self, files: DataFrame) -> DataFrame:
        """Lines of ``files`` (a selection of ``table()``) with their number ``pos`` from 0."""
        blocks = self.blocks.select("file_name", "blk", "start", "first_mid").join(files.select("file_name", "multi", "open_end", F.col("lines").alias("of")), "file_name")
        if self.few:  # or every line would be shuffled to meet its block
            blocks = F.broadcast(blocks)
        return self.lines.drop("size_bytes", "modified_at").join(blocks, ["file_name", "blk"]).withColumn("pos", F.col("start") + F.col("mid") - F.col("first_mid")).drop("start", "mid", "first_mid")

    def _members(self, files: DataFrame) -> DataFrame:
        """(file_name, pos, first) of the lines of records of several lines."""
        opens, stays = quoting(F.col("line"))
        odd = self._placed(files.where("multi")).select("file_name", "blk", "pos", opens.alias("opens"), stays.alias("stays")).where("opens OR NOT stays")
        nothing = [F.lit(None).cast(t).alias(c) for c, t in (("start", "long"), ("n", "long"), ("entry", "int"), ("open_since", "long"))]
        heads = self.blocks.join(files.where("multi").select("file_name"), "file_name", "left_semi").select("file_name", "blk", F.lit(-1).cast("long").alias("pos"), F.lit(False).alias("opens"), F.lit(True).alias("stays"), "start", "n", "entry", "open_since")
        both = heads.unionByName(odd.select("*", *nothing)).repartition("file_name", "blk").sortWithinPartitions("file_name", "blk", "pos")
        runs = both.mapInArrow(_runs, "file_name string, first long, lo long, hi long")
        return runs.select("file_name", "first", F.explode(F.sequence("lo", "hi")).alias("pos"))

    def records(self, files: DataFrame, members: DataFrame | None = None) -> DataFrame:
        """file_name, source, first and last line number (from 0), record, last_line of every record of ``files``.

        ``members``: the stored lines of records of several lines, if some file has them."""
        line = chomp(F.col("line"))
        each = F.col("pos").alias("first"), F.col("pos").alias("last"), line.alias("record"), line.alias("last_line")
        if members is None:
            return self._placed(files).select("file_name", "source", *each)
        placed = self._placed(files).join(members, ["file_name", "pos"], "left")
        single = placed.where("first IS NULL").drop("first").select("file_name", "source", *each)
        inner = F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"])
        several = placed.where("first IS NOT NULL").groupBy("file_name", "source", "first").agg(F.max("pos").alias("last"), F.max_by("line", "pos").alias("tail"), F.first("of").alias("of"), F.first("open_end").alias("open_end"), F.array_join(inner, "\n").alias("text"))
        unclosed = F.col("open_end") & (F.col("last") == F.col("of") - 1)
        whole = F.when(unclosed, F.concat("text", F.lit("\n"))).otherwise(chomp(F.col("text")))
        return single.unionByName(several.select("file_name", "source", "first", "last", whole.alias("record"), chomp(F.col("tail")).alias("last_line")))

    def members(self, files: DataFrame) -> DataFrame | None:
        """The lines of records of several lines, stored; None if no file has any."""
        if not files.where("multi").take(1):
            return None
        return self._members(files).checkpoint(eager=True)

    def oversized(self, files: DataFrame, members: DataFrame | None) -> DataFrame | None:
        """Files with a record that no field limit allows (a quote that is never closed, as a rule)."""
        if members is None:
            return None
        most = F.create_map(*[x for c in self.contracts.values() for x in (F.lit(c.table), F.lit(len(c.header) * (FIELD_LIMIT + 3)))])
        size = self._placed(files.where("multi")).join(members, ["file_name", "pos"]).groupBy("file_name", "source", "first").agg(F.sum(F.octet_length("line") + 1).alias("n"))
        return size.where(F.col("n") > most[F.col("source")]).select("file_name").distinct().checkpoint(eager=True)
