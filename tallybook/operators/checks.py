"""The column tests of all models as one table, compiled into one scan per model.

A check is (model, kind, columns, argument).  For a model all its checks become one aggregate: null,
value and tolerance checks are conditional counts; a uniqueness check groups by its key first, and the
other counts ride along in the same groups, so the model is read and shuffled once (rows of a key are
added up in every task before they move).  A relationship meets its parent with the distinct child
values only.  The result has one row per check with its number of failures: rows for null, value,
tolerance, relationship and emptiness checks, keys for uniqueness.

Models that can keep a table (``kept``) get the counts of one model after the other, each a stored row:
what one model's checks shuffle is off the disk before the next begins.

As usual for such tests, a null passes a value or relationship check and is no duplicate.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..sources.contracts import DEFAULT_POLICY


@dataclass(frozen=True)
class Check:
    model: str
    kind: str          # unique | not_null | accepted_values | relationships | within_tolerance | is_empty | sums_to_zero
    columns: tuple[str, ...] = ()
    arg: Any = None

    @property
    def name(self) -> str:
        return "_".join([self.kind, self.model, *self.columns])


def _each(model: str, kind: str, *columns: str, arg: Any = None) -> list[Check]:
    return [Check(model, kind, (c,), arg) for c in columns]


# The tests that the books must pass, and their accepted values.
CHECKS: tuple[Check, ...] = (
    Check("fx_rates_daily", "unique", ("currency", "rate_date")),
    *_each("fx_rates_daily", "not_null", "units_per_usd"),
    Check("settlement_events", "unique", ("processor", "settlement_event_id")),
    *_each("settlement_events", "not_null", "event_type", "net_settlement_minor"),
    Check("settlement_events", "accepted_values", ("event_type",), ("charge", "refund", "dispute", "dispute_fee", "dispute_reversal", "payout", "payout_reversal")),
    Check("journal_settlements", "sums_to_zero", ("journal_entry_id", "amount_usd_minor")),
    Check("journal_cash", "sums_to_zero", ("journal_entry_id", "amount_usd_minor")),
    Check("ledger_entries", "unique", ("ledger_line_id",)),
    *_each("ledger_entries", "not_null", "ledger_line_id", "journal_entry_id", "posting_date", "account_code"),
    Check("ledger_entries", "relationships", ("account_code",), ("chart_of_accounts", "account_code")),
    Check("general_ledger", "unique", ("ledger_line_id",)),
    *_each("general_ledger", "not_null", "ledger_line_id"),
    Check("general_ledger", "relationships", ("account_code",), ("chart_of_accounts", "account_code")),
    Check("trial_balance", "unique", ("month_end", "account_code")),
    Check("dim_sellers", "unique", ("seller_version_key",)),
    *_each("dim_sellers", "not_null", "seller_version_key", "valid_from"),
    Check("order_economics", "unique", ("order_id",)),
    *_each("order_economics", "not_null", "order_id", "gmv_usd_minor"),
    Check("metrics_monthly", "unique", ("order_month",)),
    *_each("metrics_monthly", "not_null", "order_month"),
    Check("seller_months", "unique", ("seller_id", "activity_month")),
    *_each("seller_months", "not_null", "seller_id", "activity_month"),
    Check("seller_months", "accepted_values", ("arrival",), ("new", "first_seen", "retained", "reactivated")),
    Check("seller_months", "accepted_values", ("departure",), ("retained", "paused", "churned", "undetermined")),
    Check("seller_churn_monthly", "unique", ("activity_month",)),
    *_each("seller_churn_monthly", "not_null", "activity_month"),
    Check("order_settlement_match", "accepted_values", ("match_status",), ("matched", "amount_mismatch", "order_without_settlement", "settlement_without_order")),
    Check("payout_reconciliation", "unique", ("payout_reference",)),
    *_each("payout_reconciliation", "not_null", "payout_reference"),
    Check("payout_reconciliation", "accepted_values", ("recon_status",), ("matched", "amount_break", "failed_and_returned", "in_transit", "bank_receipt_without_report")),
    Check("daily_reconciliation", "within_tolerance", ("ledger_vs_processor_minor",), DEFAULT_POLICY.recon_tolerance_minor),
    Check("daily_reconciliation", "accepted_values", ("break_status",), ("ok", "break")),
    *_each("orphan_dispute_reversals", "not_null", "order_id"),
    Check("orphan_dispute_reversals", "is_empty"),
    Check("batch_gaps", "is_empty"),
    Check("stg_processor_a_txns", "unique", ("balance_transaction_id",)),
    *_each("stg_processor_a_txns", "not_null", "balance_transaction_id", "created_at", "net_minor"),
    Check("stg_processor_a_payouts", "unique", ("payout_id",)),
    *_each("stg_processor_a_payouts", "not_null", "payout_id"),
    Check("stg_processor_a_payouts", "accepted_values", ("status",), ("in_transit", "paid", "failed")),
    Check("stg_processor_b_lines", "unique", ("settlement_line_id",)),
    *_each("stg_processor_b_lines", "not_null", "settlement_line_id", "created_at"),
    Check("stg_bank", "unique", ("bank_transaction_id",)),
    *_each("stg_bank", "not_null", "bank_transaction_id", "amount_minor"),
    *_each("stg_fx", "not_null", "units_per_usd"),
    Check("stg_fx", "unique", ("rate_date", "currency")),
    Check("stg_orders", "unique", ("order_id",)),
    *_each("stg_orders", "not_null", "order_id"),
    Check("stg_seller_payouts", "unique", ("seller_payout_id",)),
    *_each("stg_seller_payouts", "not_null", "seller_payout_id"),
)

# What the feeds deliver before staging: the same kinds of test on rows that do fail them.
RAW_CHECKS: tuple[Check, ...] = (
    Check("base_processor_a", "unique", ("balance_transaction_id",)),
    *_each("base_processor_a", "not_null", "balance_transaction_id", "created_at", "gross_minor", "net_minor", "order_id"),
    Check("base_processor_a", "accepted_values", ("reporting_category",), ("charge", "refund", "dispute", "payout")),
    Check("base_processor_b", "unique", ("settlement_line_id",)),
    *_each("base_processor_b", "not_null", "psp_reference", "order_id", "created_at"),
    Check("base_processor_b", "accepted_values", ("record_type",), ("Settled", "Refunded")),
    Check("base_processor_b", "relationships", ("order_id",), ("stg_orders", "order_id")),
    Check("order_settlement_match", "accepted_values", ("match_status",), ("matched",)),
    *_each("order_settlement_match", "not_null", "settlement_event_id", "order_currency"),
    Check("payout_reconciliation", "accepted_values", ("recon_status",), ("matched", "in_transit")),
    Check("daily_reconciliation", "accepted_values", ("break_status",), ("ok",)),
    Check("daily_reconciliation", "sums_to_zero", ("recon_date", "processor_net_minor")),
    Check("daily_reconciliation", "within_tolerance", ("processor_net_minor",), DEFAULT_POLICY.recon_tolerance_minor),
)


def _failing(c: Check) -> Column:
    """Whether a row fails a row-wise check."""
    if c.kind == "is_empty":
        return F.lit(True)
    col = F.col(c.columns[0])
    if c.kind == "not_null":
        return col.isNull()
    if c.kind == "accepted_values":
        return ~col.isin(*c.arg)
    return F.abs(col) > c.arg  # within_tolerance


def _key(df: DataFrame, name: str) -> Column:
    """A column to group by.  Text of lower-case hex digits, as the ids of entries and lines are, moves as its bytes, half
    as many; the first byte tells it from other text."""
    col = F.col(name)
    if df.schema[name].dataType != StringType():
        return col
    return F.when(F.lower(F.hex(F.unhex(col))) == col, F.concat(F.lit(b"\x00"), F.unhex(col))).otherwise(F.concat(F.lit(b"\x01"), col.cast("binary")))


def _counts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row: the failures of row-wise checks and of at most one uniqueness check, column f<i> for check i."""
    zero = F.lit(0).cast("bigint")
    row_wise = {i: F.count_if(_failing(c)) for i, c in enumerate(checks) if c.kind != "unique"}
    keyed = [(i, c) for i, c in enumerate(checks) if c.kind == "unique"]
    if not keyed:
        return df.agg(*[n.alias(f"f{i}") for i, n in row_wise.items()])
    (i, c), = keyed
    groups = df.groupBy(*[_key(df, x).alias(f"k{j}") for j, x in enumerate(c.columns)]).agg(F.count(F.lit(1)).alias("n"), *[n.alias(f"f{j}") for j, n in row_wise.items()])
    known = reduce(lambda a, b: a & b, [F.col(f"k{j}").isNotNull() for j in range(len(c.columns))])
    return groups.agg(F.coalesce(F.count_if((F.col("n") > 1) & known), zero).alias(f"f{i}"), *[F.coalesce(F.sum(f"f{j}"), zero).alias(f"f{j}") for j in row_wise])


def failures(models: dict[str, DataFrame] | Any, checks: tuple[Check, ...] = CHECKS) -> DataFrame:
    """check_name, model, kind, failures of every check.  ``models``: DataFrames by name, or an object that has them."""
    get = models.__getitem__ if isinstance(models, dict) else lambda name: getattr(models, name)
    kept = getattr(models, "kept", lambda df, name: df)
    out = []
    plain = [c for c in checks if c.kind not in ("relationships", "sums_to_zero")]
    for name in dict.fromkeys(c.model for c in plain):
        own = [c for c in plain if c.model == name]
        while own:  # one scan, and one more for each further uniqueness check
            first = next((c for c in own if c.kind == "unique"), None)
            now = [c for c in own if c.kind != "unique" or c is first]
            own = [c for c in own if c not in now]
            entries = [F.struct(F.lit(c.name).alias("check_name"), F.lit(c.model).alias("model"), F.lit(c.kind).alias("kind"), F.col(f"f{i}").cast("bigint").alias("failures")) for i, c in enumerate(now)]
            out.append(kept(_counts(get(name), now).select(F.inline(F.array(*entries))), f"checks_{name}"))
    for c in checks:
        if c.kind == "relationships":
            parent = get(c.arg[0]).select(F.col(c.arg[1]).alias("p")).distinct()
            values = get(c.model).groupBy(F.col(c.columns[0]).alias("v")).agg(F.count(F.lit(1)).alias("n")).filter("v IS NOT NULL")
            found = values.join(parent, F.col("v") == F.col("p"), "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("failures"))
        elif c.kind == "sums_to_zero":
            group, value = c.columns
            rows = get(c.model)
            sums = rows.groupBy(_key(rows, group).alias("k")).agg(F.sum(value).alias("s"), F.count_if(F.col(value).isNull()).alias("missing"))
            found = sums.agg(F.count_if((F.col("s") != 0) | (F.col("missing") > 0)).alias("failures"))
        else:
            continue
        out.append(kept(found.select(F.lit(c.name).alias("check_name"), F.lit(c.model).alias("model"), F.lit(c.kind).alias("kind"), "failures"), c.name))
    return reduce(DataFrame.unionAll, out)


def _sql(c: Check) -> str:
    """The failures of one check, each by a query of its own."""
    col = c.columns[0] if c.columns else ""
    if c.kind == "unique":
        keys = ", ".join(c.columns)
        known = " AND ".join(f"{x} IS NOT NULL" for x in c.columns)
        return f"SELECT count(*) FROM (SELECT DISTINCT {keys} FROM (SELECT {keys}, row_number() OVER (PARTITION BY {keys}) AS nth FROM {c.model} WHERE {known}) WHERE nth = 2)"
    if c.kind == "not_null":
        return f"SELECT count(*) - count({col}) FROM {c.model}"
    if c.kind == "accepted_values":
        return f"SELECT count({col}) FROM {c.model} ANTI JOIN (VALUES {', '.join(f'({v!r})' for v in c.arg)}) ok({col}) USING ({col})"
    if c.kind == "relationships":
        return f"SELECT count(*) FROM {c.model} WHERE {col} NOT IN (SELECT {c.arg[1]} FROM {c.arg[0]} WHERE {c.arg[1]} IS NOT NULL)"
    if c.kind == "within_tolerance":
        return f"SELECT count(*) FROM {c.model} WHERE {col} NOT BETWEEN -{c.arg} AND {c.arg}"
    if c.kind == "sums_to_zero":
        return f"SELECT count(*) FROM (SELECT 1 FROM {c.model} GROUP BY {col} HAVING sum({c.columns[1]}) <> 0 OR count(*) > count({c.columns[1]}))"
    return f"SELECT count(*) FROM {c.model}"


def oracle(checks: tuple[Check, ...]) -> tuple[str, tuple[str, ...]]:
    """SQL over the models for ``failures``, and the models that it needs."""
    rows = "\nUNION ALL\n".join(f"SELECT '{c.name}' AS check_name, '{c.model}' AS model, '{c.kind}' AS kind, CAST(({_sql(c)}) AS BIGINT) AS failures" for c in checks)
    needs = dict.fromkeys([c.model for c in checks] + [c.arg[0] for c in checks if c.kind == "relationships"])
    return rows, tuple(needs)
