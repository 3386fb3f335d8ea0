"""Dashboard cards as DataFrame functions over the marts.

Money is stored in integer cents; cards divide by 100 only for display.
Ratios are computed from summed parts, never averaged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .metrics import _div


def _usd(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c / F.lit(100)


# -- finance close ---------------------------------------------------------------
def tb_check(tb: DataFrame) -> DataFrame:
    return (tb.groupBy("month_end").agg(F.sum("closing_balance_usd_minor").alias("_s"))
            .select("month_end", _usd("_s").alias("trial_balance_net_usd"),
                    F.when(F.col("_s") == 0, "balanced").otherwise("OUT OF BALANCE").alias("status"))
            .orderBy(F.col("month_end").desc()))


def income_statement(close_pkg: DataFrame) -> DataFrame:
    return (close_pkg.filter(F.col("statement") == "income_statement")
            .orderBy(F.col("month_end").desc(), "line_order")
            .select("month_end", "section", "line_item", "amount_usd"))


def recon_days(daily: DataFrame) -> DataFrame:
    return (daily.groupBy(F.trunc("recon_date", "MM").alias("month"), "break_status")
            .agg(F.count(F.lit(1)).alias("days")).orderBy("month"))


def payout_recon_summary(payout_recon: DataFrame) -> DataFrame:
    return (payout_recon.groupBy("recon_status", "processor", "currency")
            .agg(F.count(F.lit(1)).alias("payouts"),
                 F.sum(F.abs("difference_minor")).alias("abs_difference_minor_units"))
            .orderBy(F.col("payouts").desc()))


def match_status(matches: DataFrame) -> DataFrame:
    return (matches.groupBy("match_status", "processor").agg(F.count(F.lit(1)).alias("orders"))
            .orderBy(F.col("orders").desc()))


def missing_batches(gaps: DataFrame) -> DataFrame:
    return gaps.select("missing_batch_number", "expected_payout_reference").orderBy("missing_batch_number")


def fx_cost(tb: DataFrame) -> DataFrame:
    acct, net = F.col("account_code"), F.col("period_net_usd_minor")
    return (tb.groupBy("month_end").agg(
        _usd(F.sum(F.when(acct == "5200", net).otherwise(0))).alias("realized_fx_loss_usd"),
        _usd(F.sum(F.when(acct == "5210", net).otherwise(0))).alias("unrealized_fx_loss_usd"))
        .orderBy("month_end"))


def bad_debt(aging: DataFrame) -> DataFrame:
    return (aging.groupBy("month_end").agg(
        _usd(F.sum("allowance_usd_minor")).alias("allowance_usd"),
        F.count_if("is_reserved").alias("sellers_reserved"),
        F.count_if(F.col("receivable_usd_minor") > 0).alias("sellers_negative"))
        .orderBy("month_end"))


# -- unit economics --------------------------------------------------------------
def gmv_revenue(mm: DataFrame) -> DataFrame:
    return mm.select("order_month", _usd("gmv_usd_minor").alias("gmv_usd"),
                     _usd("net_revenue_usd_minor").alias("net_revenue_usd")).orderBy("order_month")


def take_rate(mm: DataFrame) -> DataFrame:
    return mm.select("order_month", "take_rate", "contribution_margin").orderBy("order_month")


def margin_by_region(ue: DataFrame) -> DataFrame:
    return (ue.groupBy("order_month", "buyer_region")
            .agg(_div(F.sum("contribution_usd_minor"), F.sum("net_revenue_usd_minor"))
                 .alias("contribution_margin"))
            .orderBy("order_month"))


def by_processor(ue: DataFrame) -> DataFrame:
    gmv = F.sum("gmv_usd_minor")
    return ue.groupBy("processor").agg(
        _usd(gmv).alias("gmv_usd"),
        _div(F.sum("net_revenue_usd_minor"), gmv).alias("take_rate"),
        _div(F.sum("processing_cost_usd_minor"), gmv).alias("processing_cost_rate"),
        _div(F.sum("realized_fx_loss_usd_minor"), gmv).alias("fx_loss_rate"),
        _div(F.sum("contribution_usd_minor"), F.sum("net_revenue_usd_minor")).alias("contribution_margin"))


def refund_dispute(mm: DataFrame) -> DataFrame:
    return mm.select("order_month", "refund_rate", "dispute_rate_count",
                     "chargeback_loss_rate").orderBy("order_month")


def by_plan(ue: DataFrame) -> DataFrame:
    return (ue.groupBy("plan_name").agg(
        F.sum("orders").alias("orders"),
        _usd(F.sum("gmv_usd_minor")).alias("gmv_usd"),
        _div(F.sum("net_revenue_usd_minor"), F.sum("gmv_usd_minor")).alias("take_rate"),
        _div(F.sum("contribution_usd_minor"), F.sum("net_revenue_usd_minor")).alias("contribution_margin"),
        _div(F.sum("refunded_orders"), F.sum("orders")).alias("refund_rate"))
        .orderBy(F.col("gmv_usd").desc()))


# -- churn and retention ------------------------------------------------------------
def churn_rates(churn: DataFrame) -> DataFrame:
    return (churn.filter(F.col("seller_churn_rate").isNotNull())
            .select("activity_month", "seller_churn_rate", "revenue_churn_rate").orderBy("activity_month"))


def seller_flows(churn: DataFrame) -> DataFrame:
    return (churn.filter(F.col("seller_churn_rate").isNotNull())
            .select("activity_month", "new_sellers",
                    (F.col("reactivated_sellers") + F.col("first_seen_sellers")).alias("returning_sellers"),
                    (-F.col("churned_sellers")).alias("churned_sellers"))
            .orderBy("activity_month"))


def closures(churn: DataFrame) -> DataFrame:
    return (churn.filter(F.col("seller_churn_rate").isNotNull())
            .select("activity_month", "churned_sellers", "account_closures", "active_sellers")
            .orderBy("activity_month"))


def churn_by_plan(sm: DataFrame) -> DataFrame:
    dep = F.col("departure")
    return (sm.groupBy(F.col("departure_month").alias("churn_month"), "plan_name")
            .agg(_div(F.count_if(dep == "churned"), F.count(F.lit(1))).alias("seller_churn_rate"),
                 F.count_if(dep == "undetermined").alias("_und"))
            .filter(F.col("_und") == 0).drop("_und").orderBy("churn_month"))


def ltv_pooled(ltv: DataFrame) -> DataFrame:
    return (ltv.groupBy("months_since_join").agg(
        (F.sum("cumulative_contribution_usd_minor") / F.sum("cohort_size") / 100).alias("ltv_contribution_usd"),
        (F.sum("cumulative_net_revenue_usd_minor") / F.sum("cohort_size") / 100).alias("ltv_net_revenue_usd"),
        F.count(F.lit(1)).alias("cohorts"))
        .filter(F.col("cohorts") >= 3).orderBy("months_since_join"))


def _pivot_max(col: str, offsets: list[int]) -> list[Column]:
    """Manual pivot: max(value) per months-since-join offset."""
    return [F.max(F.when(F.col("months_since_join") == k, F.col(col))).alias(f"m{k}") for k in offsets]


def ltv_by_cohort(ltv: DataFrame) -> DataFrame:
    aggs = [F.any_value("cohort_size").alias("cohort_size")]
    aggs += _pivot_max("ltv_per_seller_usd_minor", [1, 3, 6, 12])
    g = ltv.groupBy("cohort_month").agg(
        *aggs, F.max_by("ltv_per_seller_usd_minor", "months_since_join").alias("_to_date"))
    return g.select("cohort_month", "cohort_size",
                    *[(F.col(f"m{k}") / 100).alias(f"m{k}") for k in (1, 3, 6, 12)],
                    (F.col("_to_date") / 100).alias("to_date")).orderBy("cohort_month")


def retention_by_cohort(cohorts: DataFrame) -> DataFrame:
    return (cohorts.groupBy("cohort_month")
            .agg(F.any_value("cohort_size").alias("cohort_size"),
                 *_pivot_max("seller_retention", [1, 2, 3, 6, 12]))
            .orderBy("cohort_month"))


def nrr_by_cohort(cohorts: DataFrame) -> DataFrame:
    return (cohorts.filter(F.col("month_one_revenue_usd_minor").isNotNull())
            .groupBy("cohort_month").agg(*_pivot_max("revenue_retention", [2, 3, 6, 12]))
            .orderBy("cohort_month"))
