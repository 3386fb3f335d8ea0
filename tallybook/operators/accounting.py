"""Month-end close: aging, FX remeasurement, bad-debt allowance, GL, trial
balance and the close package."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import to_usd_minor
from ..sources.contracts import DEFAULT_POLICY, Policy
from .journal import LEDGER_COLUMNS, _line

EUR_ACCOUNTS = ("1010", "1060", "1110")


def month_ends(ledger: DataFrame) -> DataFrame:
    """Every month-end from the first to the last month with ledger activity.

    One global min/max (partial aggregates per task), then a generated
    sequence: rows = months, never data rows.
    """
    b = ledger.agg(F.trunc(F.min("posting_date"), "MM").alias("f"),
                   F.trunc(F.max("posting_date"), "MM").alias("l"))
    return b.select(F.explode(F.when(F.col("f") <= F.col("l"), F.sequence(
        "f", "l", F.expr("interval 1 month")))).alias("m")) \
        .select(F.last_day("m").alias("month_end"))


def seller_balance_aging(ledger: DataFrame, month_ends_df: DataFrame,
                         policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """(seller, month_end): payable balance, negative streak start, reserve.

    The as-of "latest balance on or before each month end" is rewritten to
    avoid a theta join: keep the last row per (seller, posting month), then
    each such row is valid from its month to the month before the seller's
    next active month (or the last ledger month) -- an exploded interval.
    All seller windows share one shuffle on seller_id.
    """
    moves = (ledger.filter((F.col("account_code") == "2000") & F.col("seller_id").isNotNull())
             .groupBy("seller_id", "posting_date")
             .agg(F.sum(-F.col("amount_usd_minor")).alias("payable_change_usd_minor")))
    w = Window.partitionBy("seller_id").orderBy("posting_date")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    bal = (moves
           .withColumn("payable_balance_usd_minor", F.sum("payable_change_usd_minor").over(run))
           .withColumn("_prev", F.coalesce(F.lag("payable_balance_usd_minor").over(w), F.lit(0)))
           .withColumn("_streak", F.when((F.col("payable_balance_usd_minor") < 0) & (F.col("_prev") >= 0),
                                         F.col("posting_date")))
           .withColumn("negative_since",
                       F.when(F.col("payable_balance_usd_minor") < 0,
                              F.last("_streak", ignorenulls=True).over(run))))
    # Last row per (seller, month) ...
    bal = bal.withColumn("_month", F.trunc("posting_date", "MM"))
    wm = Window.partitionBy("seller_id", "_month").orderBy(F.col("posting_date").desc())
    last_in_month = bal.withColumn("_rn", F.row_number().over(wm)).filter("_rn = 1")
    # ... is valid until the month before the seller's next active month.
    bounds = month_ends_df.agg(F.trunc(F.min("month_end"), "MM").alias("_first"),
                               F.trunc(F.max("month_end"), "MM").alias("_last"))
    wn = Window.partitionBy("seller_id").orderBy("_month")
    spans = (last_in_month
             .withColumn("_next", F.lead("_month").over(wn))
             .crossJoin(F.broadcast(bounds))   # one-row scalar
             .withColumn("_to", F.coalesce(F.add_months("_next", -1), F.col("_last")))
             .filter(F.col("_month") <= F.col("_to"))
             .select("seller_id", "payable_balance_usd_minor", "negative_since",
                     F.explode(F.sequence("_month", "_to", F.expr("interval 1 month"))).alias("_m")))
    snap = spans.select("seller_id", "payable_balance_usd_minor", "negative_since",
                        F.last_day("_m").alias("month_end"))
    snap = snap.join(month_ends_df, "month_end", "left_semi")
    days = F.datediff("month_end", "negative_since")
    reserved = days >= policy.bad_debt_aging_days
    pay = F.col("payable_balance_usd_minor")
    return snap.select(
        "month_end", "seller_id", "payable_balance_usd_minor", "negative_since",
        F.when(pay.isNull(), None).when(-pay > 0, -pay).otherwise(F.lit(0)).cast("bigint")
        .alias("receivable_usd_minor"),
        days.alias("days_negative"),
        F.coalesce(reserved, F.lit(False)).alias("is_reserved"),
        F.when(reserved, -pay).otherwise(F.lit(0)).cast("bigint").alias("allowance_usd_minor"))


def fx_remeasurement(events: DataFrame, bank: DataFrame, ledger: DataFrame,
                     month_ends_df: DataFrame, rates: DataFrame) -> DataFrame:
    """Monthly change in (EUR balance at month-end rate - USD carrying amount)
    per EUR account; rows = accounts x months."""
    b = events.filter(F.col("processor") == "processor_b")
    mv = b.select(F.lit("1010").alias("account_code"), F.col("event_date").alias("d"),
                  F.col("net_settlement_minor").alias("eur_minor")).unionByName(
        b.filter(F.col("event_type") == "payout").select(
            F.lit("1060").alias("account_code"), F.col("event_date").alias("d"),
            (-F.col("net_settlement_minor")).alias("eur_minor")))
    eur_bank = bank.filter((F.col("currency") == "EUR")
                           & (F.col("counterparty_name") == "PROCESSOR B SETTLEMENT"))
    bank_mv = eur_bank.select(F.explode(F.array(F.lit("1060"), F.lit("1110"))).alias("account_code"),
                              F.col("booking_date").alias("d"), "amount_minor").select(
        "account_code", "d",
        F.when(F.col("account_code") == "1060", -F.col("amount_minor"))
        .otherwise(F.col("amount_minor")).alias("eur_minor"))
    eur_by_month = mv.unionByName(bank_mv).groupBy(
        "account_code", F.last_day("d").alias("month_end")).agg(F.sum("eur_minor").alias("eur_minor"))
    usd_by_month = (ledger.filter(F.col("account_code").isin(*EUR_ACCOUNTS))
                    .groupBy("account_code", F.last_day("posting_date").alias("month_end"))
                    .agg(F.sum("amount_usd_minor").alias("usd_minor")))
    accounts = month_ends_df.sparkSession.createDataFrame([(a,) for a in EUR_ACCOUNTS],
                                                          "account_code string")
    grid = month_ends_df.crossJoin(F.broadcast(accounts))   # 3 fixed accounts
    w = Window.partitionBy("account_code").orderBy("month_end")
    cum = w.rowsBetween(Window.unboundedPreceding, 0)
    carrying = (grid.join(eur_by_month, ["month_end", "account_code"], "left")
                .join(usd_by_month, ["month_end", "account_code"], "left")
                .select("month_end", "account_code",
                        F.sum(F.coalesce("eur_minor", F.lit(0))).over(cum).alias("eur_balance_minor"),
                        F.sum(F.coalesce("usd_minor", F.lit(0))).over(cum).alias("carrying_usd_minor")))
    eur = rates.filter(F.col("currency") == "EUR").select(
        F.col("rate_date").alias("month_end"), "units_per_usd")
    gap = carrying.join(eur, "month_end", "inner").select(
        "month_end", "account_code",
        (to_usd_minor(F.col("eur_balance_minor"), F.lit("EUR"), F.col("units_per_usd"))
         - F.col("carrying_usd_minor")).alias("gap_usd_minor"))
    return gap.select("month_end", "account_code",
                      (F.col("gap_usd_minor") - F.coalesce(F.lag("gap_usd_minor").over(w), F.lit(0)))
                      .alias("adjustment_usd_minor"))


def bad_debt_allowance(month_ends_df: DataFrame, aging: DataFrame) -> DataFrame:
    """Monthly change in the total allowance.  The global (unpartitioned)
    window runs over month rows only -- a few hundred at most."""
    totals = (month_ends_df.join(aging.groupBy("month_end").agg(
        F.sum("allowance_usd_minor").alias("a")), "month_end", "left")
        .select("month_end", F.coalesce("a", F.lit(0)).cast("bigint").alias("allowance_usd_minor")))
    w = Window.orderBy("month_end")
    return totals.select("month_end",
                         (F.col("allowance_usd_minor")
                          - F.coalesce(F.lag("allowance_usd_minor").over(w), F.lit(0)))
                         .alias("adjustment_usd_minor"))


def journal_close(remeasurement: DataFrame, allowance: DataFrame) -> DataFrame:
    """Lines of the two month-end entries; zero lines dropped."""
    fx = remeasurement.select(
        F.md5(F.concat_ws("|", F.lit("close"), F.lit("fx"), F.col("account_code"),
                          F.col("month_end").cast("string"))).alias("journal_entry_id"),
        F.col("month_end").alias("posting_date"),
        F.lit("fx_remeasurement").alias("source_event_type"),
        F.inline(F.array(_line(F.col("account_code"), F.col("adjustment_usd_minor")),
                         _line("5210", -F.col("adjustment_usd_minor")))))
    bd = allowance.select(
        F.md5(F.concat_ws("|", F.lit("close"), F.lit("bad_debt"),
                          F.col("month_end").cast("string"))).alias("journal_entry_id"),
        F.col("month_end").alias("posting_date"),
        F.lit("bad_debt_allowance").alias("source_event_type"),
        F.inline(F.array(_line("5300", F.col("adjustment_usd_minor")),
                         _line("1300", -F.col("adjustment_usd_minor")))))
    lines = fx.unionByName(bd).filter(F.col("amount_usd_minor") != 0)
    return lines.select(
        "journal_entry_id", "posting_date", "account_code", "amount_usd_minor",
        F.lit("close").alias("source_system"), "source_event_type",
        F.col("posting_date").cast("string").alias("source_reference"),
        F.lit(None).cast("string").alias("processor_reference"),
        F.lit(None).cast("bigint").alias("order_id"),
        F.lit(None).cast("bigint").alias("seller_id"),
        F.lit("USD").alias("original_currency"),
        F.col("amount_usd_minor").alias("original_amount_minor"),
        F.md5(F.concat_ws("|", "journal_entry_id", "account_code")).alias("ledger_line_id"),
        F.col("posting_date").cast("timestamp").alias("occurred_at"))


def general_ledger(ledger: DataFrame, close_lines: DataFrame) -> DataFrame:
    return ledger.select(*LEDGER_COLUMNS).unionByName(close_lines.select(*LEDGER_COLUMNS))


def trial_balance(gl: DataFrame, month_ends_df: DataFrame, accounts: DataFrame) -> DataFrame:
    """Dense (account, month_end) grid: period debit/credit/net and running
    closing balance.  Activity is pre-aggregated to (account, month) before
    it meets the grid, so the window sees months x accounts rows only."""
    amt = F.col("amount_usd_minor")
    activity = gl.groupBy("account_code", F.last_day("posting_date").alias("month_end")).agg(
        F.sum(F.when(amt > 0, amt).otherwise(0)).alias("d"),
        F.sum(F.when(amt < 0, -amt).otherwise(0)).alias("c"))
    grid = month_ends_df.crossJoin(F.broadcast(accounts))   # the 15-account chart
    g = grid.join(activity, ["month_end", "account_code"], "left").select(
        "month_end", "account_code", "account_name", "account_type", "normal_balance",
        F.coalesce("d", F.lit(0)).cast("bigint").alias("period_debit_usd_minor"),
        F.coalesce("c", F.lit(0)).cast("bigint").alias("period_credit_usd_minor"))
    w = Window.partitionBy("account_code").orderBy("month_end") \
        .rowsBetween(Window.unboundedPreceding, 0)
    net = F.col("period_debit_usd_minor") - F.col("period_credit_usd_minor")
    return g.select("*", net.alias("period_net_usd_minor"),
                    F.sum(net).over(w).alias("closing_balance_usd_minor"))


def close_package(tb: DataFrame) -> DataFrame:
    """Income statement + balance sheet line items in presentation signs."""
    t = F.col("account_type")
    pl = tb.filter(t.isin("revenue", "expense"))
    bs = tb.filter(t.isin("asset", "contra_asset", "liability"))
    is_lines = pl.select(
        "month_end", F.lit("income_statement").alias("statement"), t.alias("section"),
        F.col("account_name").alias("line_item"),
        F.col("account_code").cast("bigint").alias("line_order"),
        F.when(t == "revenue", -F.col("period_net_usd_minor"))
        .otherwise(F.col("period_net_usd_minor")).alias("amount_usd_minor"))
    ni = pl.groupBy("month_end").agg((-F.sum("period_net_usd_minor")).alias("amount_usd_minor")).select(
        "month_end", F.lit("income_statement").alias("statement"), F.lit("total").alias("section"),
        F.lit("net_income").alias("line_item"), F.lit(9999).cast("bigint").alias("line_order"),
        "amount_usd_minor")
    bs_lines = bs.select(
        "month_end", F.lit("balance_sheet").alias("statement"),
        F.when(t == "contra_asset", "asset").otherwise(t).alias("section"),
        F.col("account_name").alias("line_item"),
        F.col("account_code").cast("bigint").alias("line_order"),
        F.when(t.isin("asset", "contra_asset"), F.col("closing_balance_usd_minor"))
        .otherwise(-F.col("closing_balance_usd_minor")).alias("amount_usd_minor"))
    re_ = pl.groupBy("month_end").agg((-F.sum("closing_balance_usd_minor")).alias("amount_usd_minor")).select(
        "month_end", F.lit("balance_sheet").alias("statement"), F.lit("equity").alias("section"),
        F.lit("retained_earnings").alias("line_item"), F.lit(3000).cast("bigint").alias("line_order"),
        "amount_usd_minor")
    out = is_lines.unionByName(ni).unionByName(bs_lines).unionByName(re_)
    return out.withColumn("amount_usd",
                          (F.col("amount_usd_minor").cast("decimal(38,0)") / F.lit(100))
                          .cast("decimal(38,2)"))


def dim_sellers(plan_changes: DataFrame, sellers: DataFrame, plans: DataFrame) -> DataFrame:
    """SCD-2: one row per seller per plan period, ``[valid_from, valid_to)``."""
    w = Window.partitionBy("seller_id").orderBy("effective_from")
    versions = plan_changes.select("seller_id", "plan_id", F.col("effective_from").alias("valid_from"),
                                   F.lead("effective_from").over(w).alias("valid_to"))
    p = plans.select("plan_id", "plan_name", "fee_bps").distinct()
    s = sellers.select("seller_id", "seller_name", "seller_country",
                       F.col("status").alias("seller_status"),
                       F.col("created_at").alias("seller_created_at"),
                       F.col("churned_at").alias("seller_churned_at"))
    return (versions.join(s, "seller_id").join(p, "plan_id")
            .select("seller_id", "seller_name", "seller_country", "seller_status",
                    "seller_created_at", "seller_churned_at", "plan_id", "plan_name", "fee_bps",
                    "valid_from", "valid_to",
                    F.md5(F.concat_ws("|", F.col("seller_id").cast("string"),
                                      F.date_format("valid_from", "yyyy-MM-dd HH:mm:ss")))
                    .alias("seller_version_key"),
                    F.col("valid_to").isNull().alias("is_current")))
