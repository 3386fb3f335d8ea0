"""Registered dashboard, data-quality and operator queries with their oracles.

Each Spark query is built from the model graph; each oracle is written
independently in DuckDB SQL over the oracle's model CTEs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .oracle import duckdb_sql as osql
from .oracle.duckdb_sql import div
from .operators import activity, checks, dashboards as dash, quality as dq, recon
from .operators.metrics import metric
from .plans.models import Models

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, needs: tuple[str, ...], sql: str | None):
    def deco(fn: Callable[[Models], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from .registry import as_wall_time
            return as_wall_time(fn(Models(spark, sf_dir)))
        run.__name__ = key
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = osql.with_ctes(sql, needs)
        return fn
    return deco


# -- dashboards: finance close ----------------------------------------------------------
@register("dash_tb_check", ("general_ledger", "month_ends"), """
SELECT month_end, net / 100 AS trial_balance_net_usd, if(net = 0, 'balanced', 'OUT OF BALANCE') AS status
FROM (SELECT m.month_end, coalesce(sum(g.amount_usd_minor), 0) AS net FROM month_ends m LEFT JOIN general_ledger g ON g.posting_date <= m.month_end GROUP BY m.month_end) t""")
def _(m): return dash.tb_check(m.trial_balance)


@register("dash_income_statement", ("trial_balance",), """
SELECT month_end, section, line_item, CAST(CAST(sum(minor) AS DECIMAL(38,0)) / 100 AS DECIMAL(38,2)) AS amount_usd
FROM (SELECT month_end, unnest([account_type, 'total']) AS section, unnest([account_name, 'net_income']) AS line_item,
             unnest([if(account_type = 'revenue', -1, 1), -1]) * period_net_usd_minor AS minor
      FROM trial_balance SEMI JOIN (VALUES ('revenue'), ('expense')) kinds(account_type) USING (account_type)) lines
GROUP BY ALL""")
def _(m): return dash.income_statement(m.close_package)


@register("dash_recon_days", ("daily_reconciliation",), """
SELECT CAST(date_trunc('month', recon_date) AS DATE) AS month, break_status, count(*) AS days
FROM daily_reconciliation GROUP BY ALL ORDER BY month""")
def _(m): return dash.recon_days(m.daily_reconciliation)


@register("dash_payout_recon", ("payout_reconciliation",), """
SELECT DISTINCT recon_status, processor, currency, count(*) OVER kind AS payouts, CAST(sum(greatest(difference_minor, -difference_minor)) OVER kind AS BIGINT) AS abs_difference_minor_units
FROM payout_reconciliation WINDOW kind AS (PARTITION BY currency, processor, recon_status)""")
def _(m): return dash.payout_recon_summary(m.payout_reconciliation)


@register("dash_match_status", ("stg_orders", "settlement_events"), """
SELECT 'order_without_settlement' AS match_status, processor, count(*) AS orders FROM stg_orders o
WHERE NOT EXISTS (FROM settlement_events c WHERE c.event_type = 'charge' AND c.order_id = o.order_id) GROUP BY processor
UNION ALL
SELECT 'settlement_without_order', processor, count(*) FROM settlement_events c
WHERE event_type = 'charge' AND NOT EXISTS (FROM stg_orders o WHERE o.order_id = c.order_id) GROUP BY processor
UNION ALL
SELECT CASE coalesce((o.currency, o.amount_minor) <> (c.presentment_currency, c.presentment_amount_minor), false) WHEN true THEN 'amount_mismatch' ELSE 'matched' END, c.processor, count(*)
FROM settlement_events c JOIN stg_orders o USING (order_id) WHERE c.event_type = 'charge' GROUP BY 1, 2""")
def _(m): return dash.match_status(m.order_settlement_match)


@register("dash_missing_batches", ("raw_processor_b",), """
SELECT here + gap AS missing_batch_number, format('PAYOUT-{:04d}', here + gap) AS expected_payout_reference
FROM (SELECT here, unnest(generate_series(1, later - here - 1)) AS gap
      FROM (SELECT n AS here, lead(n) OVER (ORDER BY n) AS later
            FROM (SELECT DISTINCT TRY_CAST(nullif(regexp_extract(_source_file, 'settlement_detail_report_batch_([0-9]+)[.]csv$', 1), '') AS BIGINT) AS n FROM raw_processor_b) b
            WHERE n IS NOT NULL) steps) holes""")
def _(m): return dash.missing_batches(m.batch_gaps)


@register("dash_fx", ("general_ledger", "month_ends"), """
SELECT m.month_end, coalesce(loss[1], 0) / 100 AS realized_fx_loss_usd, coalesce(loss[2], 0) / 100 AS unrealized_fx_loss_usd
FROM month_ends m LEFT JOIN (
  SELECT last_day(posting_date) AS month_end, [sum(amount_usd_minor) FILTER (account_code = '5200'), sum(amount_usd_minor) FILTER (account_code = '5210')] AS loss
  FROM general_ledger WHERE account_code IN ('5200', '5210') GROUP BY 1) fx ON fx.month_end = m.month_end""")
def _(m): return dash.fx_cost(m.trial_balance)


@register("dash_bad_debt", ("seller_balance_aging",), """
SELECT month_end, sum(allowance_usd_minor) / 100 AS allowance_usd,
       count(*) FILTER (WHERE is_reserved) AS sellers_reserved,
       count(*) FILTER (WHERE receivable_usd_minor > 0) AS sellers_negative
FROM seller_balance_aging GROUP BY month_end ORDER BY month_end""")
def _(m): return dash.bad_debt(m.seller_balance_aging)


# The months' totals straight from the orders, one entry a measure.
_MONTHS = """FROM (SELECT order_month, map_from_entries(list((name, total))) AS t
      FROM (SELECT date_trunc('month', order_date)::DATE AS order_month, name, sum(amount) AS total
            FROM (SELECT order_date, unnest(['orders', 'refunds', 'disputes', 'gmv', 'revenue', 'margin', 'losses']) AS name,
                         unnest([1, CAST(is_refunded AS INTEGER), dispute_count, gmv_usd_minor, platform_fee_revenue_usd_minor, contribution_usd_minor, dispute_loss_to_seller_usd_minor]) AS amount
                  FROM order_economics) facts GROUP BY ALL) months GROUP BY order_month) m"""


# -- dashboards: unit economics ---------------------------------------------------------
@register("dash_gmv_revenue", ("order_economics",), f"""
SELECT order_month, CAST(t['gmv'] AS BIGINT) / 100 AS gmv_usd, CAST(t['revenue'] AS BIGINT) / 100 AS net_revenue_usd {_MONTHS}""")
def _(m): return dash.gmv_revenue(m.metrics_monthly)


@register("dash_take_rate", ("order_economics",), f"""
SELECT order_month, {div("t['revenue']", "t['gmv']")} AS take_rate, {div("t['margin']", "t['revenue']")} AS contribution_margin {_MONTHS}""")
def _(m): return dash.take_rate(m.metrics_monthly)


@register("dash_margin_by_region", ("unit_economics_monthly",), f"""
SELECT order_month, buyer_region, {div('sum(contribution_usd_minor)', 'sum(net_revenue_usd_minor)')} AS contribution_margin
FROM unit_economics_monthly GROUP BY ALL ORDER BY order_month""")
def _(m): return dash.margin_by_region(m.unit_economics_monthly)


@register("dash_by_processor", ("order_economics",), f"""
SELECT processor, g / 100 AS gmv_usd, {div('r', 'g')} AS take_rate, {div('f', 'g')} AS processing_cost_rate, {div('x', 'g')} AS fx_loss_rate, {div('r - f - x', 'r')} AS contribution_margin
FROM (SELECT processor, sum(gmv_usd_minor) AS g, sum(platform_fee_revenue_usd_minor) AS r, sum(processing_fee_usd_minor) AS f, sum(realized_fx_loss_usd_minor) AS x
      FROM order_economics GROUP BY processor) t""")
def _(m): return dash.by_processor(m.unit_economics_monthly)


@register("dash_refund_dispute", ("order_economics",), f"""
SELECT order_month, {div("t['refunds']", "t['orders']")} AS refund_rate, {div("t['disputes']", "t['orders']")} AS dispute_rate_count, {div("t['losses']", "t['gmv']")} AS chargeback_loss_rate {_MONTHS}""")
def _(m): return dash.refund_dispute(m.metrics_monthly)


@register("dash_by_plan", ("order_economics",), f"""
SELECT DISTINCT plan_name, count(*) OVER plan AS orders, sum(gmv_usd_minor) OVER plan / 100 AS gmv_usd,
       {div('sum(platform_fee_revenue_usd_minor) OVER plan', 'sum(gmv_usd_minor) OVER plan')} AS take_rate,
       {div('sum(contribution_usd_minor) OVER plan', 'sum(platform_fee_revenue_usd_minor) OVER plan')} AS contribution_margin,
       {div('count(*) FILTER (is_refunded) OVER plan', 'count(*) OVER plan')} AS refund_rate
FROM order_economics WINDOW plan AS (PARTITION BY plan_name)""")
def _(m): return dash.by_plan(m.unit_economics_monthly)


# -- dashboards: churn and retention -----------------------------------------------------
@register("dash_churn_rates", ("churn_facts", "seller_months"), f"""
SELECT month AS activity_month, {div("coalesce(t['out churned'], 0)", "t['start']")} AS seller_churn_rate, {div("coalesce(t['revenue churned'], 0)", "t['revenue']")} AS revenue_churn_rate
FROM (SELECT month, map_from_entries(list((measure, amount))) AS t FROM (SELECT month, measure, sum(amount) AS amount FROM churn_facts GROUP BY ALL) GROUP BY month) f
WHERE t['start'] > 0 AND t['out undetermined'] IS NULL AND month IN (SELECT activity_month FROM seller_months)""")
def _(m): return dash.churn_rates(m.seller_churn_monthly)


@register("dash_seller_flows", ("seller_churn_monthly",), """
SELECT activity_month, new_sellers, reactivated_sellers + first_seen_sellers AS returning_sellers,
       -churned_sellers AS churned_sellers
FROM seller_churn_monthly WHERE seller_churn_rate IS NOT NULL ORDER BY activity_month""")
def _(m): return dash.seller_flows(m.seller_churn_monthly)


@register("dash_closures", ("churn_facts", "seller_months"), """
SELECT month AS activity_month, CAST(coalesce(t['out churned'], 0) AS BIGINT) AS churned_sellers, CAST(coalesce(t['closed'], 0) AS BIGINT) AS account_closures, CAST(coalesce(t['active'], 0) AS BIGINT) AS active_sellers
FROM (SELECT month, map_from_entries(list((measure, amount))) AS t FROM (SELECT month, measure, sum(amount) AS amount FROM churn_facts GROUP BY ALL) GROUP BY month) f
WHERE t['start'] > 0 AND t['out undetermined'] IS NULL AND month IN (SELECT activity_month FROM seller_months)""")
def _(m): return dash.closures(m.seller_churn_monthly)


@register("dash_churn_by_plan", ("seller_months",), f"""
SELECT departure_month AS churn_month, plan_name,
       {div("count(*) FILTER (WHERE departure = 'churned')", 'count(*)')} AS seller_churn_rate
FROM seller_months GROUP BY departure_month, plan_name
HAVING count(*) FILTER (WHERE departure = 'undetermined') = 0 ORDER BY churn_month""")
def _(m): return dash.churn_by_plan(m.seller_months)


@register("dash_ltv_pooled", ("seller_ltv_cohorts",), """
SELECT months_since_join,
       sum(cumulative_contribution_usd_minor) / sum(cohort_size) / 100 AS ltv_contribution_usd,
       sum(cumulative_net_revenue_usd_minor) / sum(cohort_size) / 100 AS ltv_net_revenue_usd,
       count(*) AS cohorts
FROM seller_ltv_cohorts GROUP BY months_since_join HAVING count(*) >= 3 ORDER BY months_since_join""")
def _(m): return dash.ltv_pooled(m.seller_ltv_cohorts)


def _pivot_sql(col: str, offsets, scale: str = "") -> str:
    return ", ".join(f"max(CASE WHEN months_since_join = {k} THEN {col} END){scale} AS m{k}" for k in offsets)


@register("dash_ltv_cohort", ("seller_ltv_cohorts",), f"""
SELECT cohort_month, any_value(cohort_size) AS cohort_size,
       {_pivot_sql('ltv_per_seller_usd_minor', (1, 3, 6, 12), ' / 100')},
       arg_max_null(ltv_per_seller_usd_minor, months_since_join) / 100 AS to_date
FROM seller_ltv_cohorts GROUP BY cohort_month ORDER BY cohort_month""")
def _(m): return dash.ltv_by_cohort(m.seller_ltv_cohorts)


@register("dash_retention_cohort", ("seller_cohorts",), f"""
SELECT cohort_month, any_value(cohort_size) AS cohort_size, {_pivot_sql('seller_retention', (1, 2, 3, 6, 12))}
FROM seller_cohorts GROUP BY cohort_month ORDER BY cohort_month""")
def _(m): return dash.retention_by_cohort(m.seller_cohorts)


@register("dash_nrr_cohort", ("seller_cohorts",), f"""
SELECT cohort_month, {_pivot_sql('revenue_retention', (2, 3, 6, 12))}
FROM seller_cohorts WHERE month_one_revenue_usd_minor IS NOT NULL GROUP BY cohort_month ORDER BY cohort_month""")
def _(m): return dash.nrr_by_cohort(m.seller_cohorts)


# -- data quality -------------------------------------------------------------------------
_S2Z = """
SELECT {g} AS group_key, CAST(sum({v}) AS BIGINT) AS imbalance, count(*) FILTER (WHERE {v} IS NULL) AS null_lines
FROM {t} GROUP BY 1 HAVING sum({v}) <> 0 OR count(*) FILTER (WHERE {v} IS NULL) > 0"""


@register("dq_sums_to_zero_entry", ("ledger_entries",),
          _S2Z.format(g="journal_entry_id", v="amount_usd_minor", t="ledger_entries"))
def _(m): return dq.sums_to_zero(m.ledger_entries, "amount_usd_minor", "journal_entry_id")


@register("dq_sums_to_zero_month", ("ledger_entries",),
          _S2Z.format(g="CAST(date_trunc('month', posting_date) AS DATE)", v="amount_usd_minor", t="ledger_entries"))
def _(m): return dq.sums_to_zero(m.ledger_entries, "amount_usd_minor", F.trunc("posting_date", "MM"))


@register("dq_gl_sums_to_zero_entry", ("general_ledger",),
          _S2Z.format(g="journal_entry_id", v="amount_usd_minor", t="general_ledger"))
def _(m): return dq.sums_to_zero(m.general_ledger, "amount_usd_minor", "journal_entry_id")


@register("dq_tb_closing_nets_to_zero", ("trial_balance",),
          _S2Z.format(g="month_end", v="closing_balance_usd_minor", t="trial_balance"))
def _(m): return dq.sums_to_zero(m.trial_balance, "closing_balance_usd_minor", "month_end")


@register("dq_tb_period_nets_to_zero", ("trial_balance",),
          _S2Z.format(g="month_end", v="period_net_usd_minor", t="trial_balance"))
def _(m): return dq.sums_to_zero(m.trial_balance, "period_net_usd_minor", "month_end")


@register("dq_balance_sheet", ("close_package",), """
SELECT month_end, CAST(sum(CASE WHEN section = 'asset' THEN amount_usd_minor ELSE -amount_usd_minor END) AS BIGINT)
         AS imbalance_usd_minor
FROM close_package WHERE statement = 'balance_sheet' GROUP BY month_end
HAVING sum(CASE WHEN section = 'asset' THEN amount_usd_minor ELSE -amount_usd_minor END) <> 0""")
def _(m): return dq.balance_sheet_imbalance(m.close_package)


@register("dq_event_posted_once", ("settlement_events", "ledger_entries"), """
SELECT e.processor, e.settlement_event_id, coalesce(p.entries, 0) AS entries
FROM settlement_events e LEFT JOIN (
  SELECT source_system AS processor, source_reference AS settlement_event_id, count(DISTINCT journal_entry_id) AS entries
  FROM ledger_entries WHERE source_system IN ('processor_a', 'processor_b') GROUP BY ALL) p
  ON e.processor = p.processor AND e.settlement_event_id = p.settlement_event_id
WHERE coalesce(p.entries, 0) <> 1""")
def _(m): return dq.event_posted_once(m.settlement_events, m.ledger_entries)


@register("dq_metrics_tie", ("ledger_entries", "stg_orders", "metrics_monthly"), """
WITH l AS (SELECT CAST(sum(CASE WHEN e.account_code = '4000' THEN -e.amount_usd_minor ELSE 0 END) AS BIGINT) AS nr,
                  CAST(sum(CASE WHEN e.account_code = '5000' AND o.order_id IS NOT NULL THEN e.amount_usd_minor ELSE 0 END) AS BIGINT) AS pc
           FROM ledger_entries e LEFT JOIN stg_orders o ON e.order_id = o.order_id),
m AS (SELECT CAST(sum(net_revenue_usd_minor) AS BIGINT) AS nr, CAST(sum(processing_cost_usd_minor) AS BIGINT) AS pc FROM metrics_monthly)
SELECT * FROM (
  SELECT 'net_revenue' AS metric, l.nr AS ledger_usd_minor, m.nr AS metric_usd_minor FROM l CROSS JOIN m
  UNION ALL
  SELECT 'processing_cost', l.pc, m.pc FROM l CROSS JOIN m) u
WHERE ledger_usd_minor <> metric_usd_minor""")
def _(m): return dq.metrics_tie_to_ledger(m.ledger_entries, m.stg_orders, m.metrics_monthly)


@register("dq_losses_non_negative", ("order_economics", "orphan_dispute_reversals"), """
SELECT o.order_id, o.refunded_usd_minor, o.dispute_loss_to_seller_usd_minor
FROM order_economics o LEFT JOIN (SELECT DISTINCT order_id FROM orphan_dispute_reversals) r ON o.order_id = r.order_id
WHERE o.refunded_usd_minor < 0 OR (o.dispute_loss_to_seller_usd_minor < 0 AND r.order_id IS NULL)""")
def _(m): return dq.losses_not_negative(m.order_economics, m.orphan_dispute_reversals)


_LANDED = """
WITH raw_keys AS ({raw}),
landed AS (SELECT record_key, count(*) AS times_landed FROM (
  {staged}
  UNION ALL
  SELECT record_key FROM stg_exceptions WHERE source_table = '{src}') x GROUP BY record_key)
SELECT r.record_key, coalesce(l.times_landed, 0) AS times_landed
FROM raw_keys r LEFT JOIN landed l ON r.record_key = l.record_key
WHERE coalesce(l.times_landed, 0) <> 1"""


@register("dq_a_landed_once", ("raw_processor_a", "stg_processor_a_txns", "stg_exceptions"), _LANDED.format(
    raw="SELECT DISTINCT balance_transaction_id AS record_key FROM raw_processor_a WHERE balance_transaction_id <> ''",
    staged="SELECT balance_transaction_id AS record_key FROM stg_processor_a_txns", src="processor_a_balance_transactions"))
def _(m): return dq.a_landed_once(m.raw.raw_processor_a_landed, m.stg_processor_a_txns, m.stg_exceptions)


@register("dq_b_landed_once", ("raw_processor_b", "stg_processor_b_lines", "stg_exceptions"), _LANDED.format(
    raw="SELECT DISTINCT md5(concat_ws('|', coalesce(nullif(psp_reference, ''), ''), type, modification_reference)) "
        "AS record_key FROM raw_processor_b",
    staged="SELECT settlement_line_id AS record_key FROM stg_processor_b_lines", src="processor_b_settlement_details"))
def _(m): return dq.b_landed_once(m.raw.raw_processor_b, m.stg_processor_b_lines, m.stg_exceptions)


@register("dq_churn_flows", ("seller_churn_monthly",), """
SELECT * FROM seller_churn_monthly
WHERE active_sellers <> new_sellers + first_seen_sellers + retained_sellers + reactivated_sellers
   OR sellers_at_start <> retained_from_start + paused_sellers + churned_sellers + undetermined_sellers
   OR retained_sellers <> retained_from_start
   OR NOT (seller_churn_rate BETWEEN 0 AND 1)""")
def _(m): return dq.churn_flows_unbalanced(m.seller_churn_monthly)


@register("dq_recon_tolerance", ("daily_reconciliation",), """
SELECT * FROM daily_reconciliation WHERE abs(ledger_vs_processor_minor) > 100""")
def _(m): return dq.recon_outside_tolerance(m.daily_reconciliation)


@register("dq_unique_ledger_line", ("ledger_entries",), """
SELECT ledger_line_id, count(*) AS n_records FROM ledger_entries GROUP BY ledger_line_id HAVING count(*) > 1""")
def _(m): return dq.unique(m.ledger_entries, "ledger_line_id")


@register("dq_not_null_journal_entry", ("ledger_entries",), """
SELECT * FROM ledger_entries WHERE journal_entry_id IS NULL""")
def _(m): return dq.not_null(m.ledger_entries, "journal_entry_id")


@register("dq_accepted_event_types", ("settlement_events",), """
SELECT * FROM settlement_events WHERE event_type IS NULL OR event_type NOT IN
  ('charge', 'refund', 'dispute', 'dispute_fee', 'dispute_reversal', 'payout', 'payout_reversal')""")
def _(m): return dq.accepted_values(m.settlement_events, "event_type",
                                    ["charge", "refund", "dispute", "dispute_fee", "dispute_reversal",
                                     "payout", "payout_reversal"])


@register("dq_account_relationship", ("general_ledger", "chart_of_accounts"), """
SELECT g.* FROM general_ledger g WHERE g.account_code IS NOT NULL
  AND g.account_code NOT IN (SELECT account_code FROM chart_of_accounts)""")
def _(m): return dq.relationships(m.general_ledger, "account_code", m.chart_of_accounts, "account_code")


@register("dq_remeasurement_gaps", ("month_ends", "fx_rates_daily"), """
SELECT month_end FROM month_ends WHERE month_end NOT IN
  (SELECT rate_date FROM fx_rates_daily WHERE currency = 'EUR')""")
def _(m): return dq.remeasurement_months_without_rate(m.month_ends, m.fx_rates_daily)


# -- re-aimed table operators ---------------------------------------------------------------
@register("late_row_report", ("base_processor_a",), """
SELECT balance_transaction_id, min(file_date) AS first_file_date, min(CAST(created_at AS DATE)) AS event_date,
       CAST(datediff('day', min(CAST(created_at AS DATE)), min(file_date)) AS INTEGER) AS lag_days
FROM base_processor_a WHERE balance_transaction_id IS NOT NULL AND created_at IS NOT NULL
GROUP BY balance_transaction_id
HAVING datediff('day', min(CAST(created_at AS DATE)), min(file_date)) > 0""")
def _(m): return activity.late_row_report(m.base_processor_a)


@register("local_vs_utc_date", ("base_processor_b", "raw_processor_b"), """
SELECT settlement_line_id, record_type, created_at_local, source_timezone, local_date, utc_date FROM (
  SELECT md5(concat_ws('|', coalesce(nullif(psp_reference, ''), ''), type, modification_reference)) AS settlement_line_id,
         type AS record_type, creation_date AS created_at_local, timezone AS source_timezone,
         CAST(substr(creation_date, 1, 10) AS DATE) AS local_date,
         CAST(try_strptime(creation_date, '%Y-%m-%d %H:%M:%S')
              - (CASE timezone WHEN 'CET' THEN INTERVAL 1 HOUR WHEN 'CEST' THEN INTERVAL 2 HOUR END) AS DATE) AS utc_date
  FROM raw_processor_b) r
WHERE utc_date IS NOT NULL AND local_date <> utc_date""")
def _(m): return activity.local_vs_utc_date(m.base_processor_b)


@register("fx_gap_days", ("fx_rates_daily",), """
SELECT currency, CAST(date_trunc('month', rate_date) AS DATE) AS month, count(*) AS filled_days
FROM fx_rates_daily WHERE NOT is_published GROUP BY ALL""")
def _(m): return activity.fx_gap_days(m.fx_rates_daily)


@register("batch_payout_carry", ("settlement_events",), """
SELECT processor, batch, net, CAST(mx - coalesce(lag(mx) OVER (PARTITION BY processor ORDER BY batch), 0) AS BIGINT) AS payout,
       CAST(s - mx AS BIGINT) AS carry
FROM (
  SELECT *, greatest(0, max(s) OVER (PARTITION BY processor ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS mx
  FROM (
    SELECT *, sum(net) OVER (PARTITION BY processor ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s
    FROM (SELECT processor, CAST(date_trunc('month', event_date) AS DATE) AS batch, CAST(sum(net_settlement_minor) AS BIGINT) AS net
          FROM settlement_events WHERE event_type NOT IN ('payout', 'payout_reversal') GROUP BY ALL) n) r) q""")
def _(m):
    nets = (m.settlement_events.filter(~F.col("event_type").isin("payout", "payout_reversal"))
            .groupBy("processor", F.trunc("event_date", "MM").alias("batch"))
            .agg(F.sum("net_settlement_minor").alias("net")))
    return recon.batch_payout_carry(nets, key="processor", order="batch", value="net")


@register("metric_by_region", ("order_economics",), f"""
SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_month, buyer_region,
       CAST(sum(gmv_usd_minor) AS BIGINT) AS gmv,
       {div('sum(platform_fee_revenue_usd_minor)', 'sum(gmv_usd_minor)')} AS take_rate,
       {div('count(*) FILTER (WHERE is_refunded)', 'count(*)')} AS refund_rate,
       count(DISTINCT seller_id) AS active_sellers
FROM order_economics GROUP BY ALL""")
def _(m): return metric(m.order_economics, ["gmv", "take_rate", "refund_rate", "active_sellers"],
                        by=["buyer_region"], grain="month")


@register("metric_by_processor_plan_quarter", ("order_economics",), f"""
SELECT CAST(date_trunc('quarter', order_date) AS DATE) AS order_quarter, processor, plan_name,
       CAST(sum(contribution_usd_minor) AS BIGINT) AS contribution,
       {div('sum(contribution_usd_minor)', 'sum(platform_fee_revenue_usd_minor)')} AS contribution_margin,
       {div('sum(dispute_count)', 'count(*)')} AS dispute_rate_count,
       {div('sum(dispute_loss_to_seller_usd_minor)', 'sum(gmv_usd_minor)')} AS chargeback_loss_rate
FROM order_economics GROUP BY ALL""")
def _(m): return metric(m.order_economics, ["contribution", "contribution_margin", "dispute_rate_count",
                                       "chargeback_loss_rate"], by=["processor", "plan_name"], grain="quarter")


@register("order_ledger_rollup", ("ledger_entries",), """
SELECT order_id, count(*) AS lines, count(DISTINCT journal_entry_id) AS entries,
       CAST(sum(debit_usd_minor) AS BIGINT) AS debits, CAST(sum(credit_usd_minor) AS BIGINT) AS credits
FROM ledger_entries WHERE order_id IS NOT NULL GROUP BY order_id""")
def _(m):
    return (m.ledger_entries.filter(F.col("order_id").isNotNull()).groupBy("order_id")
            .agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("journal_entry_id").alias("entries"),
                 F.sum("debit_usd_minor").alias("debits"), F.sum("credit_usd_minor").alias("credits")))


@register("after_payout_events", ("settlement_events", "stg_orders", "stg_seller_payouts"), """
SELECT q.settlement_event_id, q.processor, q.event_type, q.order_id, q.seller_id, q.order_created_at,
       q.occurred_at, p.initiated_at AS next_payout_at
FROM (SELECT e.settlement_event_id, e.processor, e.event_type, e.order_id, o.seller_id,
             o.created_at AS order_created_at, e.occurred_at
      FROM settlement_events e JOIN stg_orders o ON e.order_id = o.order_id
      WHERE e.event_type IN ('refund', 'dispute')) q
ASOF JOIN (SELECT seller_id, initiated_at FROM stg_seller_payouts WHERE status IN ('paid', 'returned')) p
  ON q.seller_id = p.seller_id AND p.initiated_at > q.order_created_at
WHERE p.initiated_at < q.occurred_at""")
def _(m):
    from .operators.asof import after_payout_events
    return after_payout_events(m.settlement_events, m.stg_orders, m.stg_seller_payouts)


@register("weekend_gap_count", ("fx_rates_daily", "stg_orders"), """
SELECT r.currency, count(*) AS filled_days
FROM fx_rates_daily r,
     (SELECT CAST(min(created_at) AS DATE) AS s, CAST(max(created_at) AS DATE) AS e FROM stg_orders) b
WHERE r.currency <> 'USD' AND NOT r.is_published AND r.rate_date BETWEEN b.s AND b.e
GROUP BY r.currency""")
def _(m):
    b = m.stg_orders.agg(F.to_date(F.min("created_at")).alias("_s"), F.to_date(F.max("created_at")).alias("_e"))
    r = m.fx_rates_daily.filter((F.col("currency") != "USD") & ~F.col("is_published"))
    return (r.crossJoin(F.broadcast(b))          # one-row bounds
            .filter(F.col("rate_date").between(F.col("_s"), F.col("_e")))
            .groupBy("currency").agg(F.count(F.lit(1)).alias("filled_days")))


@register("dq_empty_warn", ("batch_gaps", "orphan_dispute_reversals", "dq_losses_non_negative_rows"), """
SELECT 'batch_gaps' AS detection_table, (SELECT count(*) FROM batch_gaps) AS row_count
UNION ALL SELECT 'orphan_dispute_reversals', (SELECT count(*) FROM orphan_dispute_reversals)
UNION ALL SELECT 'losses_not_negative', (SELECT count(*) FROM dq_losses_non_negative_rows)""")
def _(m):
    """Warn-level detection tables: a non-zero count is a finding, not a failure."""
    parts = [("batch_gaps", m.batch_gaps), ("orphan_dispute_reversals", m.orphan_dispute_reversals),
             ("losses_not_negative", dq.losses_not_negative(m.order_economics, m.orphan_dispute_reversals))]
    out = None
    for name, df in parts:
        c = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("detection_table"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out


# -- all column tests, and the same kinds of test on rows that fail them -----------------------
_ALL, _ALL_NEEDS = checks.oracle(checks.CHECKS)
_RAW, _RAW_NEEDS = checks.oracle(checks.RAW_CHECKS)


@register("dq_checks", _ALL_NEEDS, _ALL)
def _(m): return checks.failures(m, checks.CHECKS)


@register("dq_checks_raw", _RAW_NEEDS, _RAW)
def _(m): return checks.failures(m, checks.RAW_CHECKS)


# -- the loader on the feeds' files: three loads (first, same again, restated), and a backfill ---------
_FIRST = r"regexp_matches(file, 'balance_transactions_[0-9]{4}-01-01\.csv$')"
osql.cte("drop_files", ("raw_processor_a", "load_exceptions", "raw_processor_b", "raw_bank", "raw_fx"), r"""
SELECT file, source, sum(good) AS good, sum(bad) AS bad,
       CASE WHEN source = 'processor_b_settlement_details' THEN coalesce(min(day) FILTER (closing), arg_min(day, line)) ELSE try_cast(nullif(regexp_extract(file, '[0-9]{4}-[0-9]{2}-[0-9]{2}'), '') AS DATE) END AS file_date
FROM (SELECT regexp_replace(_source_file, '-[0-9]{2}[.]csv$', '-01.csv') AS file, 'processor_a_balance_transactions' AS source, 1 AS good, 0 AS bad, NULL AS day, false AS closing, NULL AS line FROM raw_processor_a
      UNION ALL SELECT regexp_replace(_source_file, '-[0-9]{2}[.]csv$', '-01.csv'), 'processor_a_balance_transactions', 0, 1, NULL, false, NULL FROM load_exceptions
      UNION ALL SELECT _source_file, 'processor_b_settlement_details', 1, 0, TRY_CAST(creation_date[1:10] AS DATE), type = 'MerchantPayout', _source_line FROM raw_processor_b
      UNION ALL SELECT regexp_replace(_source_file, '-[0-9]{2}[.]csv$', '-01.csv'), 'bank_statements', 1, 0, NULL, false, NULL FROM raw_bank
      UNION ALL SELECT regexp_replace(_source_file, '-[0-9]{2}[.]csv$', '-01.csv'), 'fx_reference_rates', 1, 0, NULL, false, NULL FROM raw_fx) lines
GROUP BY file, source""")


def _drops(key: str, needs: tuple[str, ...], sql: str):
    """Register a query over the loaded drops."""
    from .sources.drops import loaded_drops

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(loaded_drops(spark, sf_dir))
        run.__name__ = key
        QUERIES[key] = run
        ORACLE[key] = osql.with_ctes(sql, needs)
        return fn
    return deco


@_drops("load_results", ("drop_files",), f"""
SELECT run, file AS file_name, source, CASE WHEN run = 1 THEN 'loaded' WHEN run = 3 AND {_FIRST} THEN 'replaced' ELSE 'skipped' END AS status,
       CAST(CASE WHEN run = 1 OR run = 3 AND {_FIRST} THEN good ELSE 0 END AS BIGINT) AS rows,
       CAST(CASE WHEN run = 1 THEN bad WHEN run = 3 AND {_FIRST} THEN bad + 1 ELSE 0 END AS BIGINT) AS exceptions
FROM drop_files, (VALUES (1), (2), (3)) runs(run)""")
def _(d): return d.results()


@_drops("load_manifest_entries", ("drop_files",), f"""
SELECT file AS file_name, source, file_date, CAST(good AS BIGINT) AS row_count, CAST(bad + CAST({_FIRST} AS INTEGER) AS BIGINT) AS exception_count, 'loaded' AS status, '' AS reason FROM drop_files""")
def _(d): return d.warehouse.latest_manifest().select("file_name", "source", "file_date", "row_count", "exception_count", "status", "reason")


@_drops("load_settled_rows", ("raw_processor_a",), r"""
SELECT * REPLACE (CASE WHEN regexp_matches(_source_file, 'balance_transactions_[0-9]{4}-01-01\.csv$') THEN 'said "' || description || '",' || chr(10) || 'again' ELSE description END AS description)
FROM (SELECT balance_transaction_id, created_utc, currency, gross, fee, net, reporting_category, source_id, description, customer_facing_amount, automatic_payout_id, payment_metadata_order_id, regexp_replace(_source_file, '-[0-9]{2}[.]csv$', '-01.csv') AS _source_file FROM raw_processor_a) rows""")
def _(d): return d.warehouse.raw_table("processor_a_balance_transactions").select("balance_transaction_id", "created_utc", "currency", "gross", "fee", "net", "reporting_category", "source_id", "description", "customer_facing_amount", "automatic_payout_id", "payment_metadata_order_id", "_source_file")


@_drops("load_exception_rows", ("load_exceptions", "drop_files"), f"""
SELECT regexp_replace(_source_file, '-[0-9][0-9][.]csv$', '-01.csv') AS _source_file, source, reason, raw_line FROM load_exceptions
UNION ALL SELECT file, source, 'expected 14 fields, got 2', 'restated,short' FROM drop_files WHERE {_FIRST}""")
def _(d): return d.warehouse.exceptions().select("_source_file", "source", "reason", "raw_line")


@_drops("load_backfill", ("drop_files",), f"""
SELECT file AS file_name, source, 'loaded' AS status, CAST(good AS BIGINT) AS rows, CAST(bad + CAST({_FIRST} AS INTEGER) AS BIGINT) AS exceptions
FROM drop_files WHERE file_date BETWEEN DATE '1995-02-01' AND DATE '1995-04-30'""")
def _(d): return d.backfill()
