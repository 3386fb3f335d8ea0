"""Order economics, additive marts, cohorts, churn and LTV.

Every mart column is additive so roll-ups are SUMs and ratios are computed
from summed parts (never averaged).  Seller-keyed windows partition by
seller; cohort windows by cohort month; the few global windows run over
month-grained rows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import buyer_region, to_usd_minor


def _sum_if(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value).otherwise(F.lit(0)))


def _div(a, b) -> Column:
    """safe_divide: null on zero/null denominator, double result."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.when((b.isNull()) | (b == 0), F.lit(None).cast("double")) \
        .otherwise(a.cast("double") / b.cast("double"))


def months_between_starts(a: Column, b: Column) -> Column:
    """date_diff(a, b, MONTH) for month-start dates."""
    return ((F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)).cast("bigint")


def order_ledger_rollup(ledger: DataFrame) -> DataFrame:
    """Per order: revenue, costs, refunds, dispute loss, flags (one aggregation).

    Dispute entries are counted by themselves: beside a distinct count, the sums of all orders would move twice."""
    acct, et, amt = F.col("account_code"), F.col("source_event_type"), F.col("amount_usd_minor")
    rows = ledger.filter(F.col("order_id").isNotNull())
    disputes = rows.filter(et == "dispute").groupBy("order_id").agg(F.count_distinct("journal_entry_id").alias("_n"))
    sums = (rows.groupBy("order_id").agg(
                _sum_if(acct == "4000", -amt).alias("platform_fee_revenue_usd_minor"),
                _sum_if(acct == "5000", amt).alias("processing_fee_usd_minor"),
                _sum_if(acct == "5200", amt).alias("realized_fx_loss_usd_minor"),
                _sum_if((acct == "2000") & (et == "refund"), amt).alias("refunded_usd_minor"),
                (_sum_if((acct == "2000") & et.isin("dispute", "dispute_fee"), amt)
                 - _sum_if((acct == "2000") & (et == "dispute_reversal"), -amt))
                .alias("dispute_loss_to_seller_usd_minor"),
                (F.count_if(et == "charge") > 0).alias("is_settled"),
                (F.count_if(et == "refund") > 0).alias("is_refunded")))
    return sums.join(disputes, "order_id", "left") \
        .withColumn("dispute_count", F.coalesce("_n", F.lit(0).cast("bigint"))).drop("_n")


def order_economics(orders: DataFrame, rates: DataFrame, ledger: DataFrame,
                    sellers: DataFrame, plans: DataFrame) -> DataFrame:
    """order_economics: one row per order.  Rates, sellers and plans are
    dimension-sized; the ledger roll-up is keyed by order_id like orders."""
    r = rates.select(F.col("currency").alias("_rc"), F.col("rate_date").alias("_rd"), "units_per_usd")
    led = order_ledger_rollup(ledger)
    s = sellers.select("seller_id", F.col("created_at").alias("_seller_created"))
    p = plans.select(F.col("plan_id").alias("_pid"), F.col("currency").alias("_pc"), "plan_name")
    o = orders.withColumn("order_date", F.to_date("created_at"))
    j = (o.join(r, (o["currency"] == r["_rc"]) & (o["order_date"] == r["_rd"]), "left")
         .join(led, "order_id", "left")
         .join(s, "seller_id", "left")
         .join(p, (o["plan_id"] == p["_pid"]) & (o["currency"] == p["_pc"]), "left"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    return j.select(
        "order_id", "seller_id", "product_id", "buyer_country", "processor", "currency",
        "order_type", "plan_id", "created_at",
        F.col("amount_minor").alias("order_amount_minor"), "order_date",
        to_usd_minor(F.col("amount_minor"), F.col("currency"), F.col("units_per_usd"))
        .alias("gmv_usd_minor"),
        z("platform_fee_revenue_usd_minor").alias("platform_fee_revenue_usd_minor"),
        z("processing_fee_usd_minor").alias("processing_fee_usd_minor"),
        z("realized_fx_loss_usd_minor").alias("realized_fx_loss_usd_minor"),
        z("refunded_usd_minor").alias("refunded_usd_minor"),
        z("dispute_loss_to_seller_usd_minor").alias("dispute_loss_to_seller_usd_minor"),
        (z("platform_fee_revenue_usd_minor") - z("processing_fee_usd_minor")
         - z("realized_fx_loss_usd_minor")).alias("contribution_usd_minor"),
        F.coalesce("is_settled", F.lit(False)).alias("is_settled"),
        F.coalesce("is_refunded", F.lit(False)).alias("is_refunded"),
        z("dispute_count").alias("dispute_count"),
        buyer_region(F.col("buyer_country")).alias("buyer_region"),
        "plan_name",
        F.trunc(F.to_date("_seller_created"), "MM").alias("seller_cohort_month"))


def unit_economics_monthly(order_economics: DataFrame) -> DataFrame:
    """Additive cube: (month, processor, region, plan, cohort)."""
    return order_economics.groupBy(
        "processor", "buyer_region", "plan_name", "seller_cohort_month",
        F.trunc("order_date", "MM").alias("order_month")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if("is_refunded").alias("refunded_orders"),
        F.sum("dispute_count").alias("disputes"),
        F.sum("gmv_usd_minor").alias("gmv_usd_minor"),
        F.sum("platform_fee_revenue_usd_minor").alias("net_revenue_usd_minor"),
        F.sum("processing_fee_usd_minor").alias("processing_cost_usd_minor"),
        F.sum("realized_fx_loss_usd_minor").alias("realized_fx_loss_usd_minor"),
        F.sum("contribution_usd_minor").alias("contribution_usd_minor"),
        F.sum("refunded_usd_minor").alias("refunded_usd_minor"),
        F.sum("dispute_loss_to_seller_usd_minor").alias("dispute_loss_usd_minor"))


MONTHLY_SUMS = ["orders", "refunded_orders", "disputes", "gmv_usd_minor", "net_revenue_usd_minor",
                "processing_cost_usd_minor", "realized_fx_loss_usd_minor", "contribution_usd_minor",
                "refunded_usd_minor", "dispute_loss_usd_minor"]


def metrics_monthly(unit_econ: DataFrame) -> DataFrame:
    t = unit_econ.groupBy("order_month").agg(*[F.sum(c).alias(c) for c in MONTHLY_SUMS])
    return t.select(
        "*",
        _div("net_revenue_usd_minor", "gmv_usd_minor").alias("take_rate"),
        _div("contribution_usd_minor", "net_revenue_usd_minor").alias("contribution_margin"),
        _div("refunded_orders", "orders").alias("refund_rate"),
        _div("disputes", "orders").alias("dispute_rate_count"),
        _div("dispute_loss_usd_minor", "gmv_usd_minor").alias("chargeback_loss_rate"))


# Semantic layer: measures and metrics, re-aimed as one groupBy builder.
MEASURES = {
    "order_count": lambda: F.count(F.lit(1)),
    "refunded_order_count": lambda: F.count_if("is_refunded"),
    "dispute_count": lambda: F.sum("dispute_count"),
    "gmv": lambda: F.sum("gmv_usd_minor"),
    "net_revenue": lambda: F.sum("platform_fee_revenue_usd_minor"),
    "processing_cost": lambda: F.sum("processing_fee_usd_minor"),
    "contribution": lambda: F.sum("contribution_usd_minor"),
    "dispute_loss": lambda: F.sum("dispute_loss_to_seller_usd_minor"),
    "active_sellers": lambda: F.count_distinct("seller_id"),
}
METRICS = {
    "gmv": ("simple", "gmv"), "net_revenue": ("simple", "net_revenue"),
    "processing_cost": ("simple", "processing_cost"), "contribution": ("simple", "contribution"),
    "orders": ("simple", "order_count"), "refunded_orders": ("simple", "refunded_order_count"),
    "disputes": ("simple", "dispute_count"), "dispute_loss": ("simple", "dispute_loss"),
    "active_sellers": ("simple", "active_sellers"),
    "take_rate": ("ratio", ("net_revenue", "gmv")),
    "contribution_margin": ("ratio", ("contribution", "net_revenue")),
    "refund_rate": ("ratio", ("refunded_order_count", "order_count")),
    "dispute_rate_count": ("ratio", ("dispute_count", "order_count")),
    "chargeback_loss_rate": ("ratio", ("dispute_loss", "gmv")),
}
GRAINS = {"day": lambda c: c, "month": lambda c: F.trunc(c, "MM"),
          "quarter": lambda c: F.trunc(c, "quarter"), "year": lambda c: F.trunc(c, "year")}


def metric(order_economics: DataFrame, names: list[str], by: list[str] | None = None,
           grain: str = "month") -> DataFrame:
    """Query metrics by time grain and dimensions in one aggregation.

    Non-additive measures (``active_sellers``) are recomputed per slice; ratio
    metrics divide summed parts after aggregation.
    """
    by = list(by or [])
    needed = set()
    for n in names:
        kind, spec = METRICS[n]
        needed.update([spec] if kind == "simple" else spec)
    keys = [GRAINS[grain](F.col("order_date")).alias(f"order_{grain}")] + [F.col(b) for b in by]
    agg = order_economics.groupBy(*keys).agg(*[MEASURES[m]().alias(f"_m_{m}") for m in sorted(needed)])
    outs = [F.col(f"order_{grain}")] + [F.col(b) for b in by]
    for n in names:
        kind, spec = METRICS[n]
        outs.append((F.col(f"_m_{spec}") if kind == "simple"
                     else _div(F.col(f"_m_{spec[0]}"), F.col(f"_m_{spec[1]}"))).alias(n))
    return agg.select(*outs)


def seller_cohorts(order_economics: DataFrame, sellers: DataFrame) -> DataFrame:
    """Cohort x month: seller retention and revenue retention vs month 1."""
    s = sellers.select("seller_id", F.trunc(F.to_date("created_at"), "MM").alias("cohort_month"))
    sizes = s.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    act = (order_economics.join(s, "seller_id")
           .groupBy("cohort_month", F.trunc("order_date", "MM").alias("activity_month"))
           .agg(F.count_distinct("seller_id").alias("active_sellers"),
                F.sum("platform_fee_revenue_usd_minor").alias("net_revenue_usd_minor")))
    w = Window.partitionBy("cohort_month")
    base = (act.join(sizes, "cohort_month")
            .filter(F.col("activity_month") >= F.col("cohort_month"))
            .select("cohort_month", "activity_month", "cohort_size", "active_sellers",
                    "net_revenue_usd_minor",
                    months_between_starts(F.col("activity_month"), F.col("cohort_month"))
                    .alias("months_since_join"),
                    F.max(F.when(F.col("activity_month") == F.add_months("cohort_month", 1),
                                 F.col("net_revenue_usd_minor"))).over(w)
                    .alias("month_one_revenue_usd_minor")))
    return base.select(
        "*", _div("active_sellers", "cohort_size").alias("seller_retention"),
        F.when(F.col("months_since_join") >= 1,
               _div("net_revenue_usd_minor", "month_one_revenue_usd_minor")).alias("revenue_retention"))


def seller_months(order_economics: DataFrame) -> DataFrame:
    """Seller x active month with arrival and departure classification.

    The trailing partial month is removed *before* lag/lead so a data cut-off
    never reads as churn.
    """
    so = order_economics.select("order_id", "seller_id", "seller_cohort_month", "plan_name", "order_date",
                           "platform_fee_revenue_usd_minor", "contribution_usd_minor",
                           F.trunc("order_date", "MM").alias("activity_month"))
    bounds = so.agg(
        F.min("activity_month").alias("first_month"),
        F.when(F.max("order_date") == F.last_day(F.max("order_date")), F.max("activity_month"))
        .otherwise(F.add_months(F.max("activity_month"), -1)).alias("last_complete_month"))
    sm = (so.crossJoin(F.broadcast(bounds))   # one-row scalar
          .filter(F.col("activity_month") <= F.col("last_complete_month"))
          .groupBy("seller_id", "activity_month").agg(
              F.any_value("seller_cohort_month").alias("cohort_month"),
              F.max_by("plan_name", F.struct("order_date", "order_id")).alias("plan_name"),
              F.count(F.lit(1)).alias("orders"),
              F.sum("platform_fee_revenue_usd_minor").alias("net_revenue_usd_minor"),
              F.sum("contribution_usd_minor").alias("contribution_usd_minor")))
    w = Window.partitionBy("seller_id").orderBy("activity_month")
    seq = sm.select("*", F.lag("activity_month").over(w).alias("previous_active_month"),
                    F.lead("activity_month").over(w).alias("next_active_month"))
    seq = seq.crossJoin(F.broadcast(bounds))
    am, prev, nxt = F.col("activity_month"), F.col("previous_active_month"), F.col("next_active_month")
    arrival = (F.when(prev == F.add_months(am, -1), "retained")
               .when(prev.isNotNull(), "reactivated")
               .when(F.col("cohort_month") >= F.col("first_month"), "new")
               .otherwise("first_seen"))
    departure = (F.when(nxt == F.add_months(am, 1), "retained")
                 .when(nxt <= F.add_months(am, 3), "paused")
                 .when(nxt.isNotNull(), "churned")
                 .when(F.add_months(am, 3) <= F.col("last_complete_month"), "churned")
                 .otherwise("undetermined"))
    return seq.select("seller_id", "activity_month", "cohort_month", "plan_name", "orders",
                      "net_revenue_usd_minor", "contribution_usd_minor", "previous_active_month",
                      "next_active_month", arrival.alias("arrival"), departure.alias("departure"),
                      F.add_months(am, 1).alias("departure_month"))


def seller_churn_monthly(sm: DataFrame, sellers: DataFrame) -> DataFrame:
    """One row per complete month after the first: flows, churn, closures."""
    b = sm.agg(F.min("activity_month").alias("f"), F.max("activity_month").alias("l"))
    months = b.select(F.explode(F.when(F.add_months("f", 1) <= F.col("l"), F.sequence(
        F.add_months("f", 1), F.col("l"), F.expr("interval 1 month")))).alias("activity_month"))
    arr, dep = F.col("arrival"), F.col("departure")
    arrivals = sm.groupBy("activity_month").agg(
        F.count(F.lit(1)).alias("active_sellers"),
        F.count_if(arr == "new").alias("new_sellers"),
        F.count_if(arr == "first_seen").alias("first_seen_sellers"),
        F.count_if(arr == "retained").alias("retained_sellers"),
        F.count_if(arr == "reactivated").alias("reactivated_sellers"))
    departures = sm.groupBy(F.col("departure_month").alias("activity_month")).agg(
        F.count(F.lit(1)).alias("sellers_at_start"),
        F.count_if(dep == "retained").alias("retained_from_start"),
        F.count_if(dep == "paused").alias("paused_sellers"),
        F.count_if(dep == "churned").alias("churned_sellers"),
        F.count_if(dep == "undetermined").alias("undetermined_sellers"),
        F.sum("net_revenue_usd_minor").alias("start_net_revenue_usd_minor"),
        _sum_if(dep == "churned", F.col("net_revenue_usd_minor")).alias("churned_net_revenue_usd_minor"))
    closures = (sellers.filter(F.col("churned_at").isNotNull())
                .groupBy(F.trunc(F.to_date("churned_at"), "MM").alias("activity_month"))
                .agg(F.count(F.lit(1)).alias("account_closures")))
    j = months.join(arrivals, "activity_month", "left").join(departures, "activity_month", "left") \
        .join(closures, "activity_month", "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    undetermined = z("undetermined_sellers") > 0
    return j.select(
        "activity_month", z("sellers_at_start").alias("sellers_at_start"),
        z("active_sellers").alias("active_sellers"), z("new_sellers").alias("new_sellers"),
        z("first_seen_sellers").alias("first_seen_sellers"),
        z("retained_sellers").alias("retained_sellers"),
        z("reactivated_sellers").alias("reactivated_sellers"),
        z("retained_from_start").alias("retained_from_start"),
        z("paused_sellers").alias("paused_sellers"), z("churned_sellers").alias("churned_sellers"),
        z("undetermined_sellers").alias("undetermined_sellers"),
        z("start_net_revenue_usd_minor").alias("start_net_revenue_usd_minor"),
        z("churned_net_revenue_usd_minor").alias("churned_net_revenue_usd_minor"),
        z("account_closures").alias("account_closures"),
        F.when(undetermined, None).otherwise(_div("churned_sellers", "sellers_at_start"))
        .alias("seller_churn_rate"),
        F.when(undetermined, None).otherwise(
            _div("churned_net_revenue_usd_minor", "start_net_revenue_usd_minor"))
        .alias("revenue_churn_rate"))


def seller_ltv_cohorts(sm: DataFrame, sellers: DataFrame) -> DataFrame:
    """Dense cohort x month grid of cumulative revenue/contribution per joined seller."""
    b = sm.agg(F.min("activity_month").alias("first_month"), F.max("activity_month").alias("last_month"))
    cohorts = (sellers.groupBy(F.trunc(F.to_date("created_at"), "MM").alias("cohort_month"))
               .agg(F.count(F.lit(1)).alias("cohort_size")))
    grid = (cohorts.crossJoin(F.broadcast(b))
            .filter(F.col("cohort_month") >= F.col("first_month"))
            .select("cohort_month", "cohort_size", F.explode(F.when(
                F.col("cohort_month") <= F.col("last_month"),
                F.sequence("cohort_month", "last_month", F.expr("interval 1 month"))))
                .alias("activity_month")))
    monthly = sm.groupBy("cohort_month", "activity_month").agg(
        F.sum("net_revenue_usd_minor").alias("nr"), F.sum("contribution_usd_minor").alias("ct"))
    w = Window.partitionBy("cohort_month").orderBy("activity_month") \
        .rowsBetween(Window.unboundedPreceding, 0)
    j = grid.join(monthly, ["cohort_month", "activity_month"], "left")
    nr = F.coalesce("nr", F.lit(0)).cast("bigint")
    ct = F.coalesce("ct", F.lit(0)).cast("bigint")
    out = j.select("cohort_month", "activity_month", "cohort_size",
                   nr.alias("net_revenue_usd_minor"), ct.alias("contribution_usd_minor"),
                   months_between_starts(F.col("activity_month"), F.col("cohort_month"))
                   .alias("months_since_join"),
                   F.sum(nr).over(w).alias("cumulative_net_revenue_usd_minor"),
                   F.sum(ct).over(w).alias("cumulative_contribution_usd_minor"))
    return out.withColumn("ltv_per_seller_usd_minor",
                          _div("cumulative_contribution_usd_minor", "cohort_size"))
