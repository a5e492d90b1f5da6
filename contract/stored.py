"""Files and tables written to the shared folder and read back, and the frames no other module checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract import money_plans as money
from contract import tenancy_plans as tenancy
from contract.registry import PARAMS, UPDATING, Tables, check, day, vc
from contract.tenancy_plans import TENANCY
from leaseload.operators.load import append, write_rejects, write_review, write_snapshot
from leaseload.plans.tenancy import load_history_links
from leaseload.sources.contracts import UNIT_KEYS, validation_report
from leaseload.sources.exports import read_export, shared_folder
from leaseload.sources.tables import read_table


def new_folder(df: DataFrame, name: str) -> str:
    return f"{shared_folder(df.sparkSession)}/checked-{name}-{uuid.uuid4().hex}"


# -- exports ----------------------------------------------------------------------

# Cells with line breaks, quotes, commas and letters beyond ASCII. Files of odd ledgers
# are in Latin-1 and have their columns in another order.
_CELLS = {
    "LEDGER": "{o}",
    "MEMO": "CASE WHEN {o} % 3 = 0 THEN 'Zoë, of \"' || LASTNAME || '\"' || chr(10) || 'second line' WHEN {o} % 3 = 1 THEN '5\" door' END",
    "CITY": "CASE WHEN {o} % 7 = 0 THEN 'Café' || chr(13) || chr(10) || chr(10) || 'x' ELSE CITY END",
}


@check("export_files_read", ("x_former",), "SELECT {}, _o1 % 2 AS file_kind FROM x_former".format(
    ", ".join(f"{vc(c.format(o='_o1'))} AS {n.lower()}" for n, c in _CELLS.items())))
def export_files_read(t: Tables) -> DataFrame:
    """Two encodings and two column orders in one folder, cells over several lines."""
    rows = t("x_former")
    cells = rows.selectExpr(*[f"CAST({c.format(o='_row_ord')} AS STRING) AS `{n} `" for n, c in _CELLS.items()], "_row_ord % 2 AS kind")
    folder = new_folder(rows, "export")
    for kind, encoding in ((0, "UTF-8"), (1, "ISO-8859-1")):
        own = cells.filter(F.col("kind") == kind)
        own = own.select(*[c for c in (own.columns if kind else reversed(own.columns)) if c != "kind"], F.lit("9").alias("Totals & Averages"))
        own.write.options(header=True, encoding=encoding, escape='"').csv(f"{folder}/{kind}")
    read = read_export(rows.sparkSession, f"{folder}/*")
    return read.select(*[F.col(n).alias(n.lower()) for n in _CELLS], (F.col("LEDGER").cast("bigint") % 2).alias("file_kind"))


@check("review_file_read", ("x_former",), "SELECT CAST(_o1 AS VARCHAR) AS ledger, LASTNAME AS last_name, NULLIF(CITY, '') AS city FROM x_former")
def review_file_read(t: Tables) -> DataFrame:
    rows = t("x_former")
    folder = new_folder(rows, "review")
    write_review(rows.select(F.col("_row_ord").alias("ledger"), F.col("LASTNAME").alias("last_name"), F.col("CITY").alias("city")), folder)
    read = read_export(rows.sparkSession, folder, upper=False)
    return read.select("ledger", "last_name", "city")


# -- tables -----------------------------------------------------------------------


@check("stored_table_read", ("t_customers",), "SELECT id, external_id FROM t_customers WHERE external_employee_id = 3")
def stored_table_read(t: Tables) -> DataFrame:
    """A snapshot, of which only the rows and columns in scope are read."""
    rows = t("t_customers")
    folder = new_folder(rows, "snapshot")
    write_snapshot(rows, folder)
    return read_table(rows.sparkSession, folder, ("id", "external_id"), F.col("external_employee_id") == 3)


@check("appended_rows", ("t_charges_loaded",), "SELECT external_charge_id, amount_in_cents FROM t_charges_loaded")
def appended_rows(t: Tables) -> DataFrame:
    rows = t("t_charges_loaded")
    folder = new_folder(rows, "appended")
    for part in (0, 1):
        append(rows.filter(F.col("amount_in_cents") % 2 == part), folder)
    return rows.sparkSession.read.parquet(folder).select(*rows.columns)


@check("written_rejects", money.CHARGE_ADAPTERS, f"""
    SELECT "plan", row_id, reason, '2002-03-04 05:06:07' AS run_ts FROM (SELECT 'charges' AS "plan", * FROM (
        {money.rejects_sql(money.CHARGE_SQL, "CHARGEID")}))""")
def written_rejects(t: Tables) -> DataFrame:
    rejects = money.charges(t).rejects
    folder = new_folder(rejects, "rejects")
    write_rejects(rejects, "charges", PARAMS.now, folder)
    return rejects.sparkSession.read.parquet(folder).select("plan", "row_id", "reason", "run_ts")


# -- contracts ----------------------------------------------------------------------


@check("validation_report_of_other_columns", ("x_units",), f"""
    WITH n AS (SELECT CAST(count(*) AS BIGINT) AS n FROM x_units)
    SELECT 'required' AS role, k AS key, CASE WHEN k = 'POWER (YES' THEN 'POWER (YES/NO)' ELSE k END AS "column", n AS rows_total, CAST(0 AS BIGINT) AS rows_empty
    FROM n, (VALUES {", ".join(f"('{k}')" for k in UNIT_KEYS)}) AS v(k)
    UNION ALL SELECT 'ignored', 'WIDTH', 'WIDTH', n, 0 FROM n UNION ALL SELECT 'unused', 'COLOUR', 'COLOUR', n, 0 FROM n""")
def validation_report_of_other_columns(t: Tables) -> DataFrame:
    """A column the contract ignores and one it does not know."""
    rows = t("x_units")
    second = F.col("_row_ord._o2") == 1
    wider = rows.withColumns({"WIDTH": F.when(second, F.lit("10")), "COLOUR": F.when(~second, F.lit("red"))})
    return validation_report(wider, UNIT_KEYS)


# -- updates of links -----------------------------------------------------------------


def _link_hits(ctes: str) -> str:
    return f"""WITH {ctes}, hits AS (SELECT *, row_number() OVER (PARTITION BY ky ORDER BY _o1 DESC) AS rn FROM c
        WHERE b IS NULL AND k = 'duplicate')"""


@check("customer_unit_link_updates", (*TENANCY, "t_links"), f"""{_link_hits(tenancy.LINK_SQL)}
    SELECT customer_id, unit_id, {day('paid_thru')} AS paid_through_date, {vc(tenancy._dollars('DCRENT', True))} AS rental_rate FROM hits WHERE rn = 1""")
def customer_unit_link_updates(t: Tables) -> DataFrame:
    return tenancy.links(t, UPDATING).updates.select("customer_id", "unit_id", "paid_through_date", "rental_rate")


@check("history_link_updates", (*TENANCY, "t_links"), f"""{_link_hits(tenancy.HISTORY_LINK_SQL)}
    SELECT customer_id, unit_id, {day('lease_date')} AS lease_date, {day('paid_thru')} AS paid_through_date,
           {vc(tenancy._dollars('DCRENT', False))} AS rental_rate FROM hits WHERE rn = 1""")
def history_link_updates(t: Tables) -> DataFrame:
    updating = load_history_links(t("x_tenancy"), t("t_customers"), t("t_units"), t("t_links"), UPDATING)
    return updating.updates.select("customer_id", "unit_id", "lease_date", "paid_through_date", "rental_rate")
