"""Steps several plans share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaseload.functions.numbers import whole_number
from leaseload.functions.text import squeeze
from leaseload.operators.keys import attach, last_wins
from leaseload.operators.outcome import Judged, Rule, first_reason, first_value, is_sound, judged
from leaseload.operators.sieve import flag_missing
from leaseload.sources.contracts import LEDGER_COLUMNS, require
from leaseload.sources.exports import ROW_ORDER
from leaseload.sources.tables import customers_by_number, units_by_name


def nothing(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def ledger_tenants(tenants: DataFrame, names: tuple[str, ...] = ("tenant_id", "unit_name")) -> DataFrame:
    """Ledger id -> tenant id and unit name, or those of them asked for. The last row of a ledger
    wins; rows whose ledger or tenant id is not a number do not count."""
    require(tenants, LEDGER_COLUMNS)
    pairs = tenants.select(
        whole_number("LEDGERID").alias("ledger_id"),
        whole_number("TENANTID").alias("tenant_id"),
        squeeze("SUNITNAME").alias("unit_name"),
        F.col(ROW_ORDER),
    ).dropna(subset=["ledger_id", "tenant_id"])
    return last_wins(pairs, ["ledger_id"], list(names), F.col(ROW_ORDER))


def ledger_customers(tenants: DataFrame, customers: DataFrame, units: DataFrame | None = None) -> DataFrame:
    """Ledger id -> customer id (and unit id). The small lookups are joined with each
    other first, so the facts are shuffled once for all of them."""
    names = ("tenant_id",) if units is None else ("tenant_id", "unit_name")
    chained = attach(ledger_tenants(tenants, names), customers_by_number(customers), [("tenant_id", "tenant_id")])
    if units is None:
        return chained.select("ledger_id", "customer_id")
    chained = attach(chained, units_by_name(units), [("unit_name", "unit_name")])
    return chained.select("ledger_id", "customer_id", "unit_id")


def told_rows(
    rows: DataFrame, row_id: str, key: tuple[str, Column], tenants: DataFrame, customers: DataFrame, before: list[Rule], after: list[Rule]
) -> DataFrame:
    """What rejects need of rows that have ``_ledger``: reason codes and values, key, order and id.

    Rejects ask only whether a ledger has a customer, which most have. The rules of which
    ``no_customer`` is one come as they stand, all others are judged on the row alone.
    """
    late = "no_customer"
    told = {n: judged(rows, rules, (late,), n)[1] for n, rules in (("before", before), ("after", after))}

    def narrow(part: DataFrame, asked: Column, flag: Column) -> DataFrame:
        codes = []
        for name, rules in (("before", before), ("after", after)):
            part = judged(part, rules, (late,), name)[0]
            codes += [c for r in told[name] if isinstance(r, Judged) for c in (r.reason, f"{r.reason}_value")]
        # Rows that stop before any lookup need neither ledger nor key.
        first = told["before"][0]
        goes_on = F.col(first.reason).isNull() if isinstance(first, Judged) else F.lit(True)
        is_asked = asked & goes_on
        shown = F.when(is_asked | F.col("_ledger").isNull(), F.col("LEDGERID")).alias("LEDGERID")
        kept = [F.when(goes_on, c).alias(n) for n, c in ((key[0], key[1]), (ROW_ORDER, F.col(ROW_ORDER)))]
        return part.select(
            F.when(is_asked, F.col("_ledger")).alias("_ledger"), shown, F.col(row_id).cast("string").alias("_row_id"), *kept, *codes, flag
        )

    held = ledger_customers(tenants, customers).filter("customer_id IS NOT NULL")
    found = flag_missing(rows, held, ("_ledger", "ledger_id"), narrow, "_missing")
    found = found.withColumn("customer_id", F.when(~F.col("_missing"), F.lit(0)))
    return found.select(
        first_reason(told["before"]).alias("_before"),
        first_reason(told["after"]).alias("_after"),
        first_value(told["before"]).alias("_before_value"),
        first_value(told["after"]).alias("_after_value"),
        "_row_id", key[0], ROW_ORDER,
    )


def unresolved_tenants(tenants: DataFrame, customers: DataFrame) -> DataFrame:
    """Tenants of the ledgers that no customer stands for, with their ledger count."""
    chained = attach(ledger_tenants(tenants), customers_by_number(customers), [("tenant_id", "tenant_id")])
    return (
        chained.filter("customer_id IS NULL").groupBy("tenant_id").agg(F.count(F.lit(1)).alias("n_ledgers"))
    )


def classified(
    rows: DataFrame,
    row_id: Column,
    derived: dict[str, Column],
    before: list[Rule],
    after: list[Rule] | None = None,
    extra: dict[str, Column] | None = None,
    told: tuple[list[Rule], list[Rule]] | None = None,
    early: Judged | None = None,
) -> DataFrame:
    """Target columns next to the reason codes, row order and row id.

    ``told`` are both lists of rules as :func:`judged` leaves them. ``early``, the first of them,
    is named where it stops so many rows that rejects should read those apart, without lookups.
    """
    told_before, told_after = told or (before, after or [])
    return rows.select(
        *[c.alias(name) for name, c in derived.items()],
        first_reason(told_before).alias("_before"),
        first_reason(told_after).alias("_after"),
        is_sound([*before, *(after or [])]).alias("_sound"),
        first_value(told_before).alias("_before_value"),
        first_value(told_after).alias("_after_value"),
        row_id.cast("string").alias("_row_id"),
        F.col(ROW_ORDER),
        *([] if early is None else [early.told.alias("_early"), early.value.alias("_early_value")]),
        *[c.alias(name) for name, c in (extra or {}).items()],
    )
