"""Data-quality operators: each returns the offending rows (empty = pass).

Generic column tests (unique, not_null, accepted_values, relationships,
sums_to_zero, within_tolerance, is_empty) plus the invariants of the books.
All are aggregations or anti/left joins; none collects data to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.contracts import DEFAULT_POLICY, Policy


# -- generic column tests -----------------------------------------------------------
def unique(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.filter(F.col(col).isNull() | ~F.col(col).isin(*values))


# Fixed value: slots of the value filter, at most so many longs are broadcast.
VALUE_SLOTS = 1 << 20


def relationships(df: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose value has no parent.  Only the child's distinct values meet the parent.  Its rows are
    then read against the few (as a rule no) values that failed: values are dealt to slots by hash, the
    slots of those that failed are broadcast (``VALUE_SLOTS`` longs at most), and only rows in such a slot
    move to the join."""
    def slot(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(VALUE_SLOTS))

    p = parent.select(F.col(parent_col).alias("_p")).distinct()
    values = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    orphans = values.join(p, F.col("_v") == F.col("_p"), "left_anti").select("_v")
    slots = F.broadcast(orphans.select(slot("_v").alias("_slot")).distinct())
    return (df.join(slots, slot(col) == F.col("_slot"), "left_semi")
            .join(orphans, F.col(col) == F.col("_v"), "left_semi"))


def sums_to_zero(df: DataFrame, value: str, group: Column | str) -> DataFrame:
    """Groups whose signed amounts do not net to zero, or that hold null lines."""
    g = F.col(group) if isinstance(group, str) else group
    return (df.groupBy(g.alias("group_key"))
            .agg(F.sum(value).alias("imbalance"), F.count_if(F.col(value).isNull()).alias("null_lines"))
            .filter((F.col("imbalance") != 0) | (F.col("null_lines") > 0)))


def within_tolerance(df: DataFrame, col: str, tolerance: int) -> DataFrame:
    return df.filter(F.abs(F.col(col)) > tolerance)


def is_empty(df: DataFrame) -> bool:
    """Warn-level check: a detection table should be empty."""
    return df.isEmpty()


# -- invariants of the books -----------------------------------------------------------
def balance_sheet_imbalance(close_pkg: DataFrame) -> DataFrame:
    bs = close_pkg.filter(F.col("statement") == "balance_sheet")
    return (bs.groupBy("month_end").agg(
        F.sum(F.when(F.col("section") == "asset", F.col("amount_usd_minor"))
              .otherwise(-F.col("amount_usd_minor"))).alias("imbalance_usd_minor"))
        .filter(F.col("imbalance_usd_minor") != 0))


def event_posted_once(events: DataFrame, ledger: DataFrame) -> DataFrame:
    posted = (ledger.filter(F.col("source_system").isin("processor_a", "processor_b"))
              .groupBy(F.col("source_system").alias("processor"),
                       F.col("source_reference").alias("settlement_event_id"))
              .agg(F.count_distinct("journal_entry_id").alias("entries")))
    j = events.select("processor", "settlement_event_id").join(
        posted, ["processor", "settlement_event_id"], "left")
    return j.select("processor", "settlement_event_id",
                    F.coalesce("entries", F.lit(0)).alias("entries")).filter(F.col("entries") != 1)


def metrics_tie_to_ledger(ledger: DataFrame, orders: DataFrame, metrics_monthly: DataFrame) -> DataFrame:
    """Metric totals vs the ledger accounts they come from (one row per metric)."""
    o = orders.select(F.col("order_id").alias("_oid"))
    acct, amt = F.col("account_code"), F.col("amount_usd_minor")
    led = (ledger.join(o, F.col("order_id") == F.col("_oid"), "left")
           .agg(F.sum(F.when(acct == "4000", -amt).otherwise(0)).alias("net_revenue"),
                F.sum(F.when((acct == "5000") & F.col("_oid").isNotNull(), amt).otherwise(0))
                .alias("processing_cost")))
    met = metrics_monthly.agg(F.sum("net_revenue_usd_minor").alias("m_net_revenue"),
                              F.sum("processing_cost_usd_minor").alias("m_processing_cost"))
    both = led.crossJoin(met)   # one row x one row
    unpivoted = both.select(F.explode(F.array(
        F.struct(F.lit("net_revenue").alias("metric"), F.col("net_revenue").alias("ledger_usd_minor"),
                 F.col("m_net_revenue").alias("metric_usd_minor")),
        F.struct(F.lit("processing_cost").alias("metric"), F.col("processing_cost").alias("ledger_usd_minor"),
                 F.col("m_processing_cost").alias("metric_usd_minor")))).alias("r")).select("r.*")
    return unpivoted.filter(F.col("ledger_usd_minor") != F.col("metric_usd_minor"))


def losses_not_negative(order_economics: DataFrame, orphans: DataFrame) -> DataFrame:
    o = orphans.select(F.col("order_id").alias("_orphan")).distinct()
    j = order_economics.join(o, F.col("order_id") == F.col("_orphan"), "left")
    return j.filter((F.col("refunded_usd_minor") < 0)
                    | ((F.col("dispute_loss_to_seller_usd_minor") < 0) & F.col("_orphan").isNull())) \
        .select("order_id", "refunded_usd_minor", "dispute_loss_to_seller_usd_minor")


def landed_exactly_once(raw_keys: DataFrame, staged_keys: DataFrame, exception_keys: DataFrame) -> DataFrame:
    """Every distinct raw key lands once: in staging or in the exceptions."""
    landed = staged_keys.unionByName(exception_keys).groupBy("record_key") \
        .agg(F.count(F.lit(1)).alias("times_landed"))
    return (raw_keys.distinct().join(landed, "record_key", "left")
            .select("record_key", F.coalesce("times_landed", F.lit(0)).alias("times_landed"))
            .filter(F.col("times_landed") != 1))


def a_landed_once(raw_a: DataFrame, stg_a: DataFrame, exceptions: DataFrame) -> DataFrame:
    raw_keys = raw_a.filter(F.col("balance_transaction_id") != "") \
        .select(F.col("balance_transaction_id").alias("record_key"))
    staged = stg_a.select(F.col("balance_transaction_id").alias("record_key"))
    exc = exceptions.filter(F.col("source_table") == "processor_a_balance_transactions").select("record_key")
    return landed_exactly_once(raw_keys, staged, exc)


def b_landed_once(raw_b: DataFrame, stg_b: DataFrame, exceptions: DataFrame) -> DataFrame:
    key = F.md5(F.concat_ws("|", F.coalesce(F.nullif("psp_reference", F.lit("")), F.lit("")),
                            F.col("type"), F.col("modification_reference")))
    raw_keys = raw_b.select(key.alias("record_key"))
    staged = stg_b.select(F.col("settlement_line_id").alias("record_key"))
    exc = exceptions.filter(F.col("source_table") == "processor_b_settlement_details").select("record_key")
    return landed_exactly_once(raw_keys, staged, exc)


def churn_flows_unbalanced(churn: DataFrame) -> DataFrame:
    c = F.col
    return churn.filter(
        (c("active_sellers") != c("new_sellers") + c("first_seen_sellers") + c("retained_sellers")
         + c("reactivated_sellers"))
        | (c("sellers_at_start") != c("retained_from_start") + c("paused_sellers") + c("churned_sellers")
           + c("undetermined_sellers"))
        | (c("retained_sellers") != c("retained_from_start"))
        | ~c("seller_churn_rate").between(0, 1))


def recon_outside_tolerance(daily: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    return within_tolerance(daily, "ledger_vs_processor_minor", policy.recon_tolerance_minor)


def remeasurement_months_without_rate(month_ends: DataFrame, rates: DataFrame) -> DataFrame:
    """Month-ends the remeasurement silently skips (no EUR rate that day)."""
    eur = rates.filter(F.col("currency") == "EUR").select(F.col("rate_date").alias("month_end"))
    return month_ends.join(eur, "month_end", "left_anti")


# Freshness thresholds (hours) on the load timestamp.
FRESHNESS_WARN_HOURS = 26
FRESHNESS_ERROR_HOURS = 50


def source_freshness(tables: dict[str, DataFrame], now: Column | str,
                     loaded_col: str = "_loaded_at") -> DataFrame:
    """Per raw table: newest load time and pass / warn / error against ``now``.

    One global max per table (partial aggregates), unioned: rows = tables.
    """
    now_col = F.to_timestamp(F.lit(now)) if isinstance(now, str) else now
    parts = [df.agg(F.max(loaded_col).alias("max_loaded_at")).select(F.lit(name).alias("source_table"),
                                                                     "max_loaded_at")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    age_h = (F.unix_timestamp(now_col) - F.unix_timestamp("max_loaded_at")) / 3600.0
    return out.select("source_table", "max_loaded_at", age_h.alias("age_hours"),
                      F.when(F.col("max_loaded_at").isNull(), "error")
                      .when(age_h > FRESHNESS_ERROR_HOURS, "error")
                      .when(age_h > FRESHNESS_WARN_HOURS, "warn").otherwise("pass").alias("status"))
