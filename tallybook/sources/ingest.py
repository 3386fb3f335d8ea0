"""File loader: raw CSV drops -> raw records (rows and exceptions) + manifest.

* discovery and fingerprint: one parallel pass over the bytes (:mod:`lines`) gives every file's
  content fingerprint, UTF-8 validity and line count, alike at every file size; content decides
  what is unchanged (``trust_metadata=True`` also takes equal size and modification time for it and
  leaves such files unread);
* parse: records become the contract's columns, kept verbatim as strings (empty stays ''); a record
  with another number of fields, or with a carriage return outside quotes, becomes an exception;
* a header that is not exactly the contract, invalid UTF-8 or a field beyond csv's limit rejects
  the whole file;
* idempotency: a file whose (name, fingerprint) is in the manifest is skipped; a known name with a
  new fingerprint is *replaced*;
* storage: rows and exceptions of all feeds are one append-only table, partitioned by kind, source
  and load, written in one job; counts for the manifest are read back from the two narrow columns
  just written.  The manifest is written last.  Readers see only the records of each file's latest
  manifest entry, so a crash between writes leaves invisible records;
* ``compact`` rewrites the visible records once and commits them as a new version; ``vacuum``
  removes what no version needs any more.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import file_date as file_date_from_name
from .contracts import CONTRACTS
from .lines import Files, bare_return, fields, relative, source_of

MANIFEST_SCHEMA = ("load_id string, file_name string, source string, file_date date, "
                   "checksum_sha256 string, size_bytes bigint, row_count bigint, exception_count bigint, "
                   "status string, reason string, loaded_at timestamp, modified_at timestamp")

#: Feeds have at most so many columns; record column i of a feed is its column i.
WIDTH = max(len(c.header) for c in CONTRACTS.values())
RECORD_SCHEMA = (", ".join(f"c{i} string" for i in range(WIDTH))
                 + ", _source_file string, _source_line bigint, _loaded_at timestamp, reason string, raw_line string")
PARTITIONS = "kind string, source string, _load_id string"

#: Up to so many changed files are read by name; beyond, the whole drop is scanned and the rest filtered out.
LISTED = 10_000


def _py_list(arr: Column) -> Column:
    """Render an array of strings like a Python list: ['a', 'b']."""
    return F.concat(F.lit("["), F.array_join(F.transform(arr, lambda x: F.concat(F.lit("'"), x, F.lit("'"))),
                                             ", "), F.lit("]"))


def _by_source(value) -> Column:
    return F.create_map(*[x for c in CONTRACTS.values() for x in (F.lit(c.table), value(c))])[F.col("source")]


def list_files(spark: SparkSession, raw_root: str, paths: list[str] | None = None) -> DataFrame:
    """Every file of a contract under ``raw_root``: file_name, source, size_bytes, modified_at, lines,
    fingerprint, valid (UTF-8), header_ok, multi (has records of several lines), bom, open_end."""
    return Files.read(spark, raw_root, paths).table()


def _untouched(spark: SparkSession, raw_root: str, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files to read, untouched files) by name, size and modification time, without reading any content."""
    name = relative(F.col("path"), raw_root)
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(raw_root)
    meta = listing.select(name.alias("file_name"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at")) \
        .withColumn("source", source_of(F.col("file_name"))).where("source IS NOT NULL")
    same = ["file_name", "size_bytes", "modified_at"]
    return meta.join(known.select(*same), same, "left_anti"), meta.join(known.select(*same, "file_date"), same)


def _few(files: DataFrame, root: str) -> list[str] | None:
    """The paths of at most ``LISTED`` files, or None."""
    names = [r.file_name for r in files.select("file_name").limit(LISTED + 1).collect()]
    return None if len(names) > LISTED else [f"{root}/{n}" for n in names]


def _header_reasons(scan: Files, files: DataFrame) -> DataFrame:
    """file_name, reason of files whose first record is not their contract's header."""
    first = scan.records(files.withColumn("multi", F.lit(False))).where(F.col("first") == 0)
    expected = _by_source(lambda c: F.array(*map(F.lit, c.header)))
    got = fields(F.concat(F.when(F.col("bom"), F.lit("﻿")).otherwise(F.lit("")), F.col("record")))
    both = first.join(files.select("file_name", "bom"), "file_name").select("file_name", got.alias("got"), expected.alias("expected"))
    missing, unexpected = F.array_except("expected", "got"), F.array_except("got", "expected")
    return both.select("file_name", F.when((F.size(missing) > 0) | (F.size(unexpected) > 0), F.concat(
        F.lit("header mismatch; missing="), _py_list(missing), F.lit(" unexpected="), _py_list(unexpected)))
        .otherwise("header columns out of order").alias("reason"))


def _row_dates(rows: DataFrame, source: str) -> DataFrame:
    """file_name, row_date: the closing payout row's date, else that of the first dated row."""
    names = CONTRACTS[source].columns
    created = F.substring(F.col(f"c{names.index('creation_date')}"), 1, 10)
    payout = F.col(f"c{names.index('type')}") == "MerchantPayout"
    dated = rows.where((F.col("source") == source) & created.rlike(r"^\d{4}-\d{2}-\d{2}$"))
    return dated.groupBy(F.col("_source_file").alias("file_name")).agg(F.coalesce(
        F.min_by(F.when(payout, created), F.when(payout, F.col("_source_line"))), F.min_by(created, F.col("_source_line"))).alias("row_date"))


def _dates(rows: DataFrame) -> DataFrame:
    out = None
    for c in CONTRACTS.values():
        if c.dated_by == "rows":
            d = _row_dates(rows, c.table)
            out = d if out is None else out.unionByName(d)
    return out


def _file_date() -> Column:
    how = _by_source(lambda c: F.lit(c.dated_by))
    return F.when(how == "filename", file_date_from_name(F.col("file_name"))).when(how == "rows", F.try_to_date("row_date", "yyyy-MM-dd"))


def parsed(scan: Files, files: DataFrame, members: DataFrame | None, load_id: str, loaded_at: str) -> DataFrame:
    """Rows and exceptions of all records of ``files``, in the layout of the raw table."""
    records = scan.records(files, members).where("first > 0").withColumn("f", fields(F.col("record")))
    want, got = _by_source(lambda c: F.lit(len(c.header))), F.size("f")
    stray = bare_return(F.col("record"))
    reason = F.when(got != want, F.format_string("expected %d fields, got %d", want, got)).when(stray, "carriage return outside quotes")
    bad = reason.isNotNull()
    return records.select(
        *[F.when(~bad, F.get("f", F.lit(i))).alias(f"c{i}") for i in range(WIDTH)],
        F.col("file_name").alias("_source_file"), (F.col("last") + 1).alias("_source_line"), F.to_timestamp(F.lit(loaded_at)).alias("_loaded_at"),
        reason.alias("reason"), F.when(bad, F.col("last_line")).alias("raw_line"),
        F.when(bad, "exception").otherwise("row").alias("kind"), "source", F.lit(load_id).alias("_load_id"))


class Warehouse:
    """Append-only raw layer on a (shared) filesystem path.

    ``records/kind=/source=/_load_id=`` holds what loads append.  ``packed/version=N`` holds the visible
    records of the loads that ``packed_loads`` lists for N, rewritten; readers take the newest N, and
    appended records of all other loads.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        if table == "load_exceptions":
            return f"{self.root}/raw/records/kind=exception"
        return f"{self.root}/raw/records/kind=row/source={table}" if table in CONTRACTS else f"{self.root}/raw/{table}"

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _read(self, path: str, schema: str) -> DataFrame:
        """Always with the declared schema (a table may hold no files yet)."""
        fs, p = self._fs(path)
        return self.spark.read.schema(schema).parquet(path) if fs.exists(p) else self.spark.createDataFrame([], schema)

    def manifest(self) -> DataFrame:
        return self._read(self.path("load_manifest"), MANIFEST_SCHEMA)

    def latest_manifest(self) -> DataFrame:
        """Newest manifest row per file (ties broken by load id)."""
        m = self.manifest()
        newest = m.groupBy("file_name").agg(F.max_by(F.struct(*[c for c in m.columns if c != "file_name"]), F.struct("loaded_at", "load_id")).alias("m"))
        return newest.select("file_name", "m.*").select(*m.columns)

    def packed_loads(self) -> DataFrame:
        return self._read(self.path("packed_loads"), "version int, load_id string")

    def version(self) -> int:
        """The newest committed compaction (0: none)."""
        return self.packed_loads().agg(F.max("version")).first()[0] or 0

    def stored(self) -> DataFrame:
        """All records as stored: the newest version, and what later loads appended."""
        appended = self._read(f"{self.root}/raw/records", f"{RECORD_SCHEMA}, {PARTITIONS}")
        n = self.version()
        if not n:
            return appended
        folded = self.packed_loads().where(F.col("version") == n).select(F.col("load_id").alias("_load_id"))
        packed = self._read(f"{self.root}/raw/packed/version={n}", f"{RECORD_SCHEMA}, {PARTITIONS}")
        return packed.unionByName(appended.join(folded, "_load_id", "left_anti"))

    def records(self, kind: str) -> DataFrame:
        """Visible records: those written by each file's latest manifest entry."""
        lm = self.latest_manifest()
        if kind == "row":
            lm = lm.where("status <> 'rejected'")
        lm = lm.select(F.col("file_name").alias("_source_file"), F.col("load_id").alias("_load_id"))
        return self.stored().where(F.col("kind") == kind).join(lm, ["_source_file", "_load_id"], "left_semi")

    def raw_table(self, table: str) -> DataFrame:
        names = CONTRACTS[table].columns
        return self.records("row").where(F.col("source") == table).select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)], "_source_file", "_source_line", "_loaded_at", "_load_id")

    def exceptions(self) -> DataFrame:
        return self.records("exception").select("_source_file", "_load_id", "_loaded_at", "source", F.col("_source_line").alias("line_number"), "reason", "raw_line")

    def write_batch(self, records: DataFrame) -> None:
        records.write.mode("append").partitionBy("kind", "source", "_load_id").parquet(f"{self.root}/raw/records")

    def appended(self, load_id: str) -> DataFrame:
        """What one load has appended (its partitions only are read)."""
        return self._read(f"{self.root}/raw/records", f"{RECORD_SCHEMA}, {PARTITIONS}").where(F.col("_load_id") == load_id)

    def compact(self) -> int:
        """Rewrite the visible records of all loads so far into a new version, and commit it.

        The version exists for readers once its list of loads is written, which is the last step: a crash
        before leaves the old version in force.  A load that runs meanwhile is not in the list and
        stays readable where it was appended."""
        loads = self.manifest().select("load_id").distinct().checkpoint(eager=True)
        if not loads.take(1):
            return self.version()
        n = max([self.version(), *self._versions()]) + 1
        mine = loads.select(F.col("load_id").alias("_load_id"))
        for kind in ("row", "exception"):
            self.records(kind).join(mine, "_load_id", "left_semi").write.mode("append").partitionBy("kind", "source").parquet(f"{self.root}/raw/packed/version={n}")
        loads.select(F.lit(n).alias("version"), "load_id").coalesce(1).write.mode("append").parquet(self.path("packed_loads"))
        return n

    def _versions(self) -> list[int]:
        fs, p = self._fs(f"{self.root}/raw/packed")
        return [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(p)] if fs.exists(p) else []

    def vacuum(self) -> list[str]:
        """Remove versions before the newest, unfinished ones, and appended loads that the newest holds; returns the folders.

        Not while a compaction or a reader of an old version is at work."""
        n = self.version()
        if not n:
            return []
        gone = [f"{self.root}/raw/packed/version={v}" for v in self._versions() if v != n]
        folded = {r.load_id for r in self.packed_loads().where(F.col("version") == n).select("load_id").toLocalIterator()}
        fs, p = self._fs(f"{self.root}/raw/records/kind=*/source=*/_load_id=*")
        gone += [s.getPath().toString() for s in fs.globStatus(p) or [] if s.getPath().getName().split("=", 1)[1] in folded]
        for path in gone:
            fs, p = self._fs(path)
            fs.delete(p, True)
        return gone


RESULT_SCHEMA = "file_name string, source string, status string, rows bigint, exceptions bigint"


def ingest(spark: SparkSession, raw_root: str, warehouse: Warehouse, start=None, end=None,
           load_id: str | None = None, paths: list[str] | None = None, trust_metadata: bool = False) -> DataFrame:
    """Load every new or changed file under ``raw_root`` (or of ``paths`` below it); returns per-file results.

    ``start`` / ``end``: only dated files in the range, undated ones are passed over."""
    raw_root, load_id = raw_root.rstrip("/"), load_id or uuid.uuid4().hex
    loaded_at = spark.sql("select current_timestamp() as t").first().t.strftime("%Y-%m-%d %H:%M:%S.%f")
    known = warehouse.latest_manifest().checkpoint(eager=True)
    none = F.lit(0).cast("bigint")
    ranged = start is not None or end is not None

    def in_range(files: DataFrame) -> DataFrame:
        if start is not None:
            files = files.where(F.col("file_date") >= F.lit(str(start)).cast("date"))
        if end is not None:
            files = files.where(F.col("file_date") <= F.lit(str(end)).cast("date"))
        return files

    def unchanged(files: DataFrame) -> DataFrame:
        return in_range(files).select("file_name", "source", F.lit("skipped").alias("status"), none.alias("rows"), none.alias("exceptions"))

    skipped = spark.createDataFrame([], RESULT_SCHEMA)
    if trust_metadata and paths is None:
        todo, untouched = _untouched(spark, raw_root, known)
        skipped, paths = unchanged(untouched), _few(todo, raw_root)
        if paths == []:
            return skipped.checkpoint(eager=True)
    scan = Files.read(spark, raw_root, paths)
    of = known.select("file_name", F.col("checksum_sha256").alias("_sum"), F.col("file_date").alias("_date"))
    table = scan.table().join(of, "file_name", "left")
    same = F.col("_sum").eqNullSafe(F.col("fingerprint"))
    alike = unchanged(table.where(same).withColumn("file_date", F.col("_date")))
    if trust_metadata:  # untouched files may have been read along with many others
        alike = alike.join(skipped.select("file_name"), "file_name", "left_anti")
    skipped = skipped.unionByName(alike)
    new = table.where(~same).drop("_date").withColumn("_known", F.col("_sum").isNotNull()).drop("_sum").checkpoint(eager=True)
    if not new.take(1):
        return skipped.checkpoint(eager=True)
    if ranged:
        dates = _dates(parsed(scan, new.where(_by_source(lambda c: F.lit(c.dated_by)) == "rows"), None, load_id, loaded_at).where("kind = 'row'"))
        new = in_range(new.join(dates, "file_name", "left").withColumn("file_date", _file_date())).drop("row_date", "file_date").checkpoint(eager=True)
    if table.count() > new.count():  # only the changed files are read again
        again = _few(new, raw_root)
        if again == []:
            return skipped.checkpoint(eager=True)
        if again is not None:
            scan = Files.read(spark, raw_root, again)

    bad = new.where("valid AND NOT header_ok")
    reasons = new.where("NOT valid").select("file_name", F.lit("file is not valid UTF-8").alias("reason"))
    if bad.take(1):
        reasons = reasons.unionByName(_header_reasons(scan, bad))
    good = new.where("valid AND header_ok")
    members = scan.members(good)
    huge = scan.oversized(good, members)
    if huge is not None:
        reasons = reasons.unionByName(huge.select("file_name", F.lit("field larger than field limit (131072)").alias("reason")))
    reasons = reasons.checkpoint(eager=True)  # one row a rejected file
    meta = new.join(reasons, "file_name", "left").checkpoint(eager=True)
    good = new.join(reasons.select("file_name"), "file_name", "left_anti")

    records = parsed(scan, good, members, load_id, loaded_at)
    rejected = meta.where("reason IS NOT NULL").select(
        *[F.lit(None).cast("string").alias(f"c{i}") for i in range(WIDTH)], F.col("file_name").alias("_source_file"), F.lit(1).cast("bigint").alias("_source_line"),
        F.to_timestamp(F.lit(loaded_at)).alias("_loaded_at"), "reason", F.lit("").alias("raw_line"), F.lit("exception").alias("kind"), "source", F.lit(load_id).alias("_load_id"))
    warehouse.write_batch(records.unionByName(rejected) if reasons.take(1) else records)

    written = warehouse.appended(load_id)
    counts = written.groupBy(F.col("_source_file").alias("file_name")).agg(F.count_if(F.col("kind") == "row").alias("n_rows"), F.count_if(F.col("kind") == "exception").alias("n_bad"))
    done = meta.join(counts, "file_name", "left").join(_dates(written.where("kind = 'row'")), "file_name", "left")
    is_rejected = F.col("reason").isNotNull()
    n_rows, n_bad = F.coalesce("n_rows", none).alias("row_count"), F.when(is_rejected, none).otherwise(F.coalesce("n_bad", none)).alias("exception_count")
    done = done.select(
        F.lit(load_id).alias("load_id"), "file_name", "source", _file_date().alias("file_date"), F.col("fingerprint").alias("checksum_sha256"), F.col("size_bytes").cast("bigint").alias("size_bytes"),
        n_rows, n_bad, F.when(is_rejected, "rejected").otherwise("loaded").alias("status"), F.coalesce("reason", F.lit("")).alias("reason"),
        F.to_timestamp(F.lit(loaded_at)).alias("loaded_at"), F.col("modified_at").cast("timestamp").alias("modified_at"), "_known").checkpoint(eager=True)
    status = F.when((F.col("status") == "loaded") & F.col("_known"), "replaced").otherwise(F.col("status"))
    results = done.select("file_name", "source", status.alias("status"), F.col("row_count").alias("rows"), F.col("exception_count").alias("exceptions")).unionByName(skipped).checkpoint(eager=True)
    done.drop("_known").write.mode("append").parquet(warehouse.path("load_manifest"))
    return results


def verify_load(warehouse: Warehouse) -> DataFrame:
    """Per-file row and exception counts against the latest manifest entry, plus rows whose (file, load)
    has no manifest entry at all (a crashed load).  One pass over two narrow columns of the records."""
    stored = warehouse.stored().groupBy(F.col("source").alias("table"), F.col("_source_file").alias("file_name"), F.col("_load_id").alias("load_id")).agg(
        F.count_if(F.col("kind") == "row").alias("rows"), F.count_if(F.col("kind") == "exception").alias("errs")).checkpoint(eager=True)
    latest = warehouse.latest_manifest().where("status = 'loaded'").select("file_name", "load_id", F.col("source").alias("table"), "row_count", "exception_count")
    found = latest.join(stored.drop("table"), ["file_name", "load_id"], "left")
    rows, errs = F.coalesce("rows", F.lit(0)), F.coalesce("errs", F.lit(0))
    wrong = found.where((rows != F.col("row_count")) | (errs != F.col("exception_count"))).select("file_name", "table", F.format_string(
        "warehouse has %d rows / %d exceptions, manifest says %d / %d", rows, errs, F.col("row_count"), F.col("exception_count")).alias("problem"))
    orphan = stored.join(warehouse.manifest().select("file_name", "load_id"), ["file_name", "load_id"], "left_anti").where("rows > 0") \
        .select("file_name", "table", F.format_string("rows in %s with no manifest entry", F.col("table")).alias("problem"))
    return wrong.unionByName(orphan)


class WarehouseFeeds:
    """The raw feeds as seen by the models, read from a loaded warehouse
    (the production path: files -> :func:`ingest` -> models)."""

    def __init__(self, warehouse: Warehouse):
        self.wh = warehouse
        self.spark = warehouse.spark

    @property
    def cache_key(self) -> str:
        """Stored model tables are per warehouse and newest load: a later load makes new ones."""
        newest = self.wh.manifest().agg(F.max(F.struct("loaded_at", "load_id")).alias("m")).first().m
        return f"warehouse:{self.wh.root}:{newest.loaded_at}:{newest.load_id}" if newest else f"warehouse:{self.wh.root}"

    def _t(self, table: str) -> DataFrame:
        return self.wh.raw_table(table)

    @property
    def raw_processor_a_landed(self) -> DataFrame:
        return self._t("processor_a_balance_transactions")

    @property
    def raw_processor_a_payouts(self) -> DataFrame:
        return self._t("processor_a_payouts")

    @property
    def raw_processor_b(self) -> DataFrame:
        return self._t("processor_b_settlement_details")

    @property
    def raw_bank(self) -> DataFrame:
        return self._t("bank_statements")

    @property
    def raw_fx(self) -> DataFrame:
        return self._t("fx_reference_rates")

    @property
    def raw_orders(self) -> DataFrame:
        return self._t("app_db_orders")

    @property
    def raw_refunds(self) -> DataFrame:
        return self._t("app_db_refunds")

    @property
    def raw_sellers(self) -> DataFrame:
        return self._t("app_db_sellers")

    @property
    def raw_plan_changes(self) -> DataFrame:
        return self._t("app_db_seller_plan_changes")

    @property
    def raw_products(self) -> DataFrame:
        return self._t("app_db_products")

    @property
    def raw_plans(self) -> DataFrame:
        return self._t("app_db_plans")

    @property
    def raw_plan_fixed_fees(self) -> DataFrame:
        return self._t("app_db_plan_fixed_fees")

    @property
    def raw_seller_payouts(self) -> DataFrame:
        return self._t("app_db_seller_payouts")

    @property
    def load_exceptions(self) -> DataFrame:
        return self.wh.exceptions()

    @property
    def load_manifest(self) -> DataFrame:
        return self.wh.manifest()
