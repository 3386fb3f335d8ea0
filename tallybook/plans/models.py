"""The model graph: every staging, intermediate and mart table as a lazily
built DataFrame, wired in dependency order.

Nothing executes until an action: each property returns a logical plan and
Catalyst optimises the whole chain a caller asks for (filters and column
pruning reach the parquet scans).  Models with several readers can be
materialised once with :meth:`Models.materialize`, which writes Parquet to
the cluster's shared checkpoint folder and reads it back: lineage is cut
and a lost executor recomputes nothing upstream.
"""

from __future__ import annotations

import uuid
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import accounting as acc
from ..operators import journal, metrics, recon, staging
from ..operators.fx import fx_rates_daily
from ..session import apply_runtime_defaults, ensure_checkpoint_dir, store
from ..sources.contracts import DEFAULT_POLICY, Policy, chart_of_accounts
from ..sources.driver import DriverFeeds, landing_lock

# Dependency waves for a full build: everything inside one wave is
# independent, so its jobs are submitted concurrently (Spark schedules the
# tasks of all of them on the same executors).
BUILD_WAVES = [
    ["raw.orders_all", "raw.raw_fx", "raw.raw_sellers", "raw.raw_plan_changes", "raw.raw_products"],
    ["raw.base_events", "raw.seller_payout_rows", "raw.raw_orders", "raw.raw_refunds"],
    ["raw.payouts", "raw.raw_seller_payouts", "fx_rates_daily"],
    ["raw.raw_processor_a", "raw.raw_processor_b", "raw.raw_bank", "raw.raw_processor_a_payouts"],
    ["settlement_events", "stg_bank"],
    ["settlement_postings", "cash_postings", "raw.load_manifest"],
    ["month_ends", "order_economics"],
    ["seller_balance_aging", "seller_months"],
    ["trial_balance"],
]

# Models stored as tables (written once per application and dataset, then
# read back): the ones with several downstream readers.  Everything else is
# a view -- a lazy plan that Catalyst folds into its reader.
TABLE_MODELS = ("fx_rates_daily", "stg_bank", "settlement_events", "settlement_postings", "cash_postings", "month_ends",
                "seller_balance_aging", "trial_balance", "order_economics", "seller_months")
_TABLES: dict[tuple, str] = {}


class Models:
    published = 0   # how often books were published in this application

    def __init__(self, spark: SparkSession, sf_dir: str, policy: Policy = DEFAULT_POLICY,
                 feeds: DriverFeeds | None = None, tables: bool = True, books: str | None = None):
        """``books``: folder of the published books.  Once :meth:`publish` has filled it, the ledger and the general
        ledger are read from there, partition by partition, and publishing again posts the lookback months only."""
        apply_runtime_defaults(spark)
        self.books = books.rstrip("/") if books else None
        self.spark = spark
        self.sf_dir = sf_dir
        self.policy = policy
        self.tables = tables
        self.raw = feeds or DriverFeeds(spark, sf_dir, land=tables)
        self.source = getattr(self.raw, "cache_key", sf_dir)   # the state of the feeds these models are of

    def build(self, threads: int = 4) -> dict[str, float]:
        """Materialise every feed and table, wave by wave; returns seconds per wave."""
        import time
        from concurrent.futures import ThreadPoolExecutor

        def touch(path: str) -> None:
            obj = self
            for part in path.split("."):
                obj = getattr(obj, part)

        timings = {}
        with ThreadPoolExecutor(max_workers=threads) as pool:
            for i, wave in enumerate(BUILD_WAVES):
                t = time.time()
                for f in [pool.submit(touch, p) for p in wave]:
                    f.result()
                timings[f"wave{i}"] = round(time.time() - t, 3)
        return timings

    def posted_since(self, cutoff: date | None) -> DataFrame:
        """Ledger lines with a posting date from ``cutoff`` on (None: all), posted from the events, bank rows and
        seller payouts of those months only; amounts that older payouts booked are looked up from payout events."""
        if cutoff is None:
            return journal.ledger_entries(self.journal_settlements, self.journal_cash)
        since = F.lit(cutoff)
        settled = journal.journal_settlements(self._events.filter(F.col("event_month") >= since).drop("event_month") if self.books
                                              else self.settlement_events.filter(F.col("event_date") >= since), self.stg_orders, self.fx_rates_daily)
        cash = journal.journal_cash(self.stg_bank.filter(F.col("booking_date") >= since), journal.payout_transit(self.settlement_events, self.fx_rates_daily),
                                    self.fx_rates_daily, self.stg_seller_payouts).filter(F.col("posting_date") >= since)
        return journal.ledger_entries(settled, cash)

    def publish_ledger(self, path: str, full_refresh: bool = False) -> dict:
        """Write the ledger to its month-partitioned table; on an existing one only the lookback months are posted."""
        from ..sources.sinks import lookback_cutoff, write_ledger
        cutoff = None if full_refresh else lookback_cutoff(self.spark, path, self.policy.ledger_lookback_days)
        return write_ledger(self.spark, self.posted_since(cutoff), path, self.policy, full_refresh)

    def publish(self, full_refresh: bool = False) -> dict:
        """Bring the published books up to date: the ledger, then the general ledger with its close lines."""
        from ..sources.sinks import write_general_ledger
        info = self.publish_ledger(f"{self.books}/ledger_entries", full_refresh)
        Models.published += 1   # stored tables of the state before are not read any more
        info["general_ledger"] = write_general_ledger(self.spark, self.ledger_entries_by_month, self.journal_close, f"{self.books}/general_ledger", info["cutoff"])
        return info

    def _book(self, name: str) -> DataFrame | None:
        """A published table with its month, or None if there is none yet."""
        from ..sources.sinks import stored_months
        if not self.books or not stored_months(self.spark, f"{self.books}/{name}"):
            return None
        return self.spark.read.parquet(f"{self.books}/{name}")

    def _m(self, name: str, build, by: str | None = None) -> DataFrame:
        """A table model: written once to the shared checkpoint folder (lineage
        cut, executor-loss safe), then every reader scans the Parquet copy."""
        if not self.tables or name not in TABLE_MODELS:
            return build()
        state = (self.books, Models.published) if self.books else ()
        key = (self.spark.sparkContext.applicationId, self.source, self.policy, name, *state)
        with landing_lock(key):
            path = _TABLES.get(key)
            if path is None:
                root = ensure_checkpoint_dir(self.spark)
                path = f"{root}/tables-{uuid.uuid4().hex[:10]}/{name}"
                df = build().hint("rebalance", by) if by else build()
                store(df, path, by)
                _TABLES[key] = path
        return self.spark.read.parquet(path)

    def kept(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as a table of its own, written now: the disk that its job takes is free again for the next one's."""
        if not self.tables:
            return df
        path = f"{ensure_checkpoint_dir(self.spark)}/kept-{uuid.uuid4().hex[:10]}/{name}"
        store(df, path)
        return self.spark.read.parquet(path)

    # -- staging -------------------------------------------------------------
    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw.raw_orders)

    @cached_property
    def stg_plans(self) -> DataFrame:
        return staging.stg_plans(self.raw.raw_plans, self.raw.raw_plan_fixed_fees)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw.raw_products)

    @cached_property
    def stg_refunds(self) -> DataFrame:
        return staging.stg_refunds(self.raw.raw_refunds)

    @cached_property
    def stg_seller_payouts(self) -> DataFrame:
        return staging.stg_seller_payouts(self.raw.raw_seller_payouts)

    @cached_property
    def stg_plan_changes(self) -> DataFrame:
        return staging.stg_plan_changes(self.raw.raw_plan_changes)

    @cached_property
    def stg_sellers(self) -> DataFrame:
        return staging.stg_sellers(self.raw.raw_sellers)

    @property
    def stg_bank(self) -> DataFrame:
        return self._m("stg_bank", lambda: staging.stg_bank(self.raw.raw_bank))

    @cached_property
    def stg_fx(self) -> DataFrame:
        return staging.stg_fx(self.raw.raw_fx)

    @cached_property
    def base_processor_a(self) -> DataFrame:
        return staging.base_processor_a(self.raw.raw_processor_a_landed)

    @cached_property
    def stg_processor_a_txns(self) -> DataFrame:
        return staging.stg_processor_a_txns(self.base_processor_a)

    @cached_property
    def stg_processor_a_payouts(self) -> DataFrame:
        return staging.stg_processor_a_payouts(self.raw.raw_processor_a_payouts)

    @cached_property
    def base_processor_b(self) -> DataFrame:
        return staging.base_processor_b(self.raw.raw_processor_b)

    @cached_property
    def stg_processor_b_lines(self) -> DataFrame:
        return staging.stg_processor_b_lines(self.base_processor_b)

    @cached_property
    def stg_exceptions(self) -> DataFrame:
        app = {t: getattr(self.raw, t.replace("app_db_", "raw_").replace("seller_plan_changes", "plan_changes")) for t in staging.APP_TIMES}
        return staging.stg_exceptions(self.base_processor_a, self.base_processor_b, self.raw.load_exceptions,
                                      staging.app_exceptions(app), staging.fx_exceptions(self.raw.raw_fx))

    @cached_property
    def chart_of_accounts(self) -> DataFrame:
        return chart_of_accounts(self.spark)

    # -- intermediate --------------------------------------------------------
    @property
    def fx_rates_daily(self) -> DataFrame:
        return self._m("fx_rates_daily", lambda: fx_rates_daily(self.stg_fx))

    @property
    def _events(self) -> DataFrame:
        """Settlement events by month, for posting from a cutoff on."""
        return self._m("settlement_events", lambda: journal.settlement_events(
            self.stg_processor_a_txns, self.stg_processor_b_lines).withColumn("event_month", F.trunc("event_date", "MM")), by="event_month")

    @property
    def settlement_events(self) -> DataFrame:
        if self.books:
            return self._events.drop("event_month")
        return self._m("settlement_events", lambda: journal.settlement_events(
            self.stg_processor_a_txns, self.stg_processor_b_lines))

    @property
    def settlement_postings(self) -> DataFrame:
        """Journal entries of settlements, stored one row an entry; their lines and ids are views."""
        return self._m("settlement_postings", lambda: journal.settlement_postings(
            self.settlement_events, self.stg_orders, self.fx_rates_daily))

    @property
    def cash_postings(self) -> DataFrame:
        return self._m("cash_postings", lambda: journal.cash_postings(
            self.stg_bank, journal.payout_transit(self.settlement_events, self.fx_rates_daily),
            self.fx_rates_daily, self.stg_seller_payouts))

    @property
    def journal_settlements(self) -> DataFrame:
        return journal.settlement_lines(self.settlement_postings)

    @property
    def journal_cash(self) -> DataFrame:
        return journal.cash_lines(self.cash_postings)

    @property
    def ledger_entries_by_month(self) -> DataFrame:
        """The ledger with ``posting_month``: the published partitions, if there are any."""
        book = self._book("ledger_entries")
        return book if book is not None else self.ledger_entries.withColumn("posting_month", F.trunc("posting_date", "MM"))

    @property
    def ledger_entries(self) -> DataFrame:
        book = self._book("ledger_entries")
        if book is not None:
            return book.drop("posting_month")
        return self.posted_since(None)

    @property
    def month_ends(self) -> DataFrame:
        return self._m("month_ends", lambda: acc.month_ends(self.ledger_entries))

    @property
    def seller_balance_aging(self) -> DataFrame:
        return self._m("seller_balance_aging", lambda: acc.seller_balance_aging(self.ledger_entries, self.month_ends, self.policy))

    @property
    def fx_remeasurement(self) -> DataFrame:
        return acc.fx_remeasurement(self.settlement_events, self.stg_bank, self.ledger_entries,
                                    self.month_ends, self.fx_rates_daily)

    @property
    def bad_debt_allowance(self) -> DataFrame:
        return acc.bad_debt_allowance(self.month_ends, self.seller_balance_aging)

    @property
    def journal_close(self) -> DataFrame:
        return acc.journal_close(self.fx_remeasurement, self.bad_debt_allowance)

    # -- marts ---------------------------------------------------------------
    @property
    def general_ledger(self) -> DataFrame:
        # Published: its month partitions.  Otherwise a view: the ledger table plus a few hundred close lines.
        book = self._book("general_ledger")
        if book is not None:
            return book.select(*journal.LEDGER_COLUMNS)
        return acc.general_ledger(self.ledger_entries, self.journal_close)

    def general_ledger_month(self, month: date) -> DataFrame:
        """One month of the general ledger; published, only that month's partition is read."""
        book = self._book("general_ledger")
        if book is not None:
            return book.filter(F.col("posting_month") == F.lit(month)).select(*journal.LEDGER_COLUMNS)
        return self.general_ledger.filter(F.trunc("posting_date", "MM") == F.lit(month))

    @property
    def trial_balance(self) -> DataFrame:
        return self._m("trial_balance", lambda: acc.trial_balance(
            self.general_ledger, self.month_ends, self.chart_of_accounts))

    @property
    def close_package(self) -> DataFrame:
        return acc.close_package(self.trial_balance)

    @property
    def dim_sellers(self) -> DataFrame:
        return acc.dim_sellers(self.stg_plan_changes, self.stg_sellers, self.stg_plans)

    @property
    def order_economics(self) -> DataFrame:
        return self._m("order_economics", lambda: metrics.order_economics(self.stg_orders, self.fx_rates_daily, self.ledger_entries,
                                       self.stg_sellers, self.stg_plans))

    @property
    def unit_economics_monthly(self) -> DataFrame:
        return metrics.unit_economics_monthly(self.order_economics)

    @property
    def metrics_monthly(self) -> DataFrame:
        return metrics.metrics_monthly(self.unit_economics_monthly)

    @property
    def seller_cohorts(self) -> DataFrame:
        return metrics.seller_cohorts(self.order_economics, self.stg_sellers)

    @property
    def seller_months(self) -> DataFrame:
        return self._m("seller_months", lambda: metrics.seller_months(self.order_economics))

    @property
    def seller_churn_monthly(self) -> DataFrame:
        return metrics.seller_churn_monthly(self.seller_months, self.stg_sellers)

    @property
    def seller_ltv_cohorts(self) -> DataFrame:
        return metrics.seller_ltv_cohorts(self.seller_months, self.stg_sellers)

    @property
    def order_settlement_match(self) -> DataFrame:
        return recon.order_settlement_match(self.stg_orders, self.settlement_events)

    @property
    def payout_reconciliation(self) -> DataFrame:
        return recon.payout_reconciliation(self.settlement_events, self.stg_bank, self.policy)

    @property
    def daily_reconciliation(self) -> DataFrame:
        return recon.daily_reconciliation(self.settlement_events, self.ledger_entries,
                                          self.payout_reconciliation, self.policy)

    @property
    def orphan_dispute_reversals(self) -> DataFrame:
        return recon.orphan_dispute_reversals(self.ledger_entries)

    @property
    def batch_gaps(self) -> DataFrame:
        return recon.batch_gaps(self.raw.load_manifest)
