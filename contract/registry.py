"""Registry of checked queries and small builders for their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract.adapters import frame, with_adapters
from leaseload.params import Params
from leaseload.session import tune

RUN_TS = datetime(2002, 3, 4, 5, 6, 7)
AS_OF = date(1998, 6, 15)
NOW_SQL = "TIMESTAMP '2002-03-04 05:06:07'"
TODAY_SQL = "DATE '1998-06-15'"
PARAMS = Params(run_ts=RUN_TS, as_of=AS_OF)
UPDATING = Params(run_ts=RUN_TS, as_of=AS_OF, on_match="update")

Tables = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Check:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    adapters: tuple[str, ...]
    over: Callable[[Tables], DataFrame]


CHECKS: dict[str, Check] = {}


def shown(df: DataFrame, as_text: tuple[str, ...] = ()) -> DataFrame:
    """Dates, times and decimals as plain text, so that both engines hash them alike."""
    kinds = dict(df.dtypes)
    columns = []
    for name, kind in kinds.items():
        column = F.col(f"`{name}`")
        if kind == "date":
            column = F.date_format(column, "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif kind.startswith("decimal") or name in as_text:
            column = column.cast("string")
        columns.append(column.alias(name))
    return df.select(*columns)


def check(
    name: str, adapters: tuple[str, ...], sql: str | None, as_text: tuple[str, ...] = ()
) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a query: the function gets a reader of adapters by name."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def over(tables: Tables) -> DataFrame:
            return shown(build(tables), as_text)

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return over(lambda adapter: frame(spark, sf_dir, adapter))

        if name in CHECKS:
            raise ValueError(f"query {name} is registered twice")
        CHECKS[name] = Check(run, None if sql is None else with_adapters(adapters, sql), adapters, over)
        return build

    return register


# -- DuckDB spellings, written apart from the Spark expressions they check ------


def num(x: str) -> str:
    return f"TRY_CAST(trim({x}) AS DOUBLE)"


def _digits(x: str) -> str:
    return f"regexp_extract(trim({x}), '^([+-]?[0-9]+)(\\.[0-9]*)?$', 1)"


def big(x: str) -> str:
    whole = f"TRY_CAST(TRY_CAST({_digits(x)} AS HUGEINT) AS BIGINT)"
    return f"CASE WHEN {_digits(x)} <> '' THEN {whole} ELSE TRY_CAST(trunc({num(x)}) AS BIGINT) END"


def idt(x: str) -> str:
    return f"COALESCE(CAST({big(x)} AS VARCHAR), NULLIF({_digits(x)}, ''), NULLIF(trim({x}), ''))"


def _cents(plain: str) -> str:
    """Cents of a numeric text, null beyond a bigint; large amounts have two places at most in the data."""
    amount = f"TRY_CAST({plain} AS DOUBLE)"
    return (
        f"CASE WHEN abs({amount}) < 9e13 THEN TRY_CAST(round_even({amount} * 100, 0) AS BIGINT) "
        f"ELSE TRY_CAST(TRY_CAST({plain} AS DECIMAL(30,2)) * 100 AS BIGINT) END"
    )


def cents(x: str) -> str:
    return _cents(f"trim({x})")


def money_cents(x: str) -> str:
    plain = f"replace(ltrim(trim({x}), '$'), ',', '')"
    return f"CASE WHEN TRY_CAST({plain} AS DOUBLE) IS NULL THEN 0 ELSE {_cents(plain)} END"


def too_large(x: str) -> str:
    """A number whose cents do not fit."""
    return f"({num(x)} IS NOT NULL AND {cents(x)} IS NULL)"


def clean(x: str) -> str:
    return f"CASE WHEN lower(trim({x})) NOT IN ('', 'nan', 'none') THEN trim({x}) END"


def strptime(x: str, formats: list[str]) -> str:
    listed = ", ".join(f"'{f}'" for f in formats)
    return f"try_strptime(trim({x}), [{listed}])"


PAYMENT_FORMATS = [
    "%m/%d/%Y %H:%M:%S.%f", "%m/%d/%Y %H:%M:%S", "%m/%d/%Y %H:%M", "%m/%d/%Y", "%Y-%m-%d %H:%M:%S.%f",
    "%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%m-%d-%Y %H:%M:%S.%f", "%m-%d-%Y %H:%M:%S", "%m-%d-%Y %H:%M", "%m-%d-%Y",
]
FREE_FORMATS = [
    "%m/%d/%Y %I:%M:%S %p", "%Y-%m-%dT%H:%M:%S", *PAYMENT_FORMATS, "%d/%m/%Y",
]


def paid_at(x: str) -> str:
    t = strptime(x, PAYMENT_FORMATS)
    return f"CASE WHEN year({t}) >= 1970 THEN {t} END"


def free_at(x: str) -> str:
    return strptime(x, FREE_FORMATS)


def ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def vc(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def empty(x: str) -> str:
    return f"COALESCE(trim({x}) = '', TRUE)"


# Lookups as the oracles write them: plain group-by winners.
LEDGERS = f"""ledgers AS (
    SELECT ledger_id, arg_max(tenant_id, o) AS tenant_id, arg_max(unit_name, o) AS unit_name FROM (
        SELECT {big('LEDGERID')} AS ledger_id, {big('TENANTID')} AS tenant_id, COALESCE(trim(SUNITNAME), '') AS unit_name,
               _o1 * 10 + _o2 AS o FROM x_tenants)
    WHERE ledger_id IS NOT NULL AND tenant_id IS NOT NULL GROUP BY ledger_id)"""
CUSTOMERS = f"""customers AS (
    SELECT {big('external_id')} AS tenant_id, max(id) AS customer_id FROM t_customers
    WHERE {big('external_id')} IS NOT NULL GROUP BY 1)"""
TEXT_CUSTOMERS = """customers AS (
    SELECT trim(external_id) AS tenant_key, max(id) AS customer_id FROM t_customers GROUP BY 1)"""
UNITS = "units AS (SELECT trim(unit_number) AS unit_name, max(id) AS unit_id FROM t_units GROUP BY 1)"

# From a classified CTE ``c`` (b, k, a: reasons before, at and after the stored keys;
# ky: conflict key; _o*: row order) to the frames an outcome has.
RANKED = """c2 AS (SELECT *, CASE WHEN b IS NULL AND a IS NULL
    THEN row_number() OVER (PARTITION BY b IS NULL AND a IS NULL, ky ORDER BY {order}) END AS rn,
    COALESCE(b, k, a) AS r FROM c)"""


def accepted_sql(ctes: str, columns: str, order: str = "_o1, _o2, _o3") -> str:
    return f"WITH {ctes}, {RANKED.format(order=order)} SELECT {columns} FROM c2 WHERE rn = 1 AND k IS NULL"


def counters_sql(ctes: str, outcomes: dict[str, str], order: str = "_o1, _o2, _o3", updating: bool = False) -> str:
    """``outcomes`` names the reasons that are no skips."""
    cases = " ".join(f"WHEN reason = '{reason}' THEN '{outcome}'" for reason, outcome in outcomes.items())
    again, hit = ("matched", "WHEN reason = 'matched' THEN 'update'") if updating else ("repeat_in_file", "")
    judged = (
        f"CASE WHEN b IS NULL AND a IS NULL AND k = 'duplicate' THEN 'matched' WHEN b IS NOT NULL THEN b "
        f"WHEN k <> 'duplicate' THEN k WHEN a IS NOT NULL THEN a WHEN rn = 1 THEN 'new' ELSE '{again}' END"
        if updating
        else f"COALESCE(r, CASE WHEN rn = 1 THEN 'new' ELSE '{again}' END)"
    )
    return f"""WITH {ctes}, {RANKED.format(order=order)},
        judged AS (SELECT {judged} AS reason FROM c2)
        SELECT CASE WHEN reason = 'new' THEN 'insert' {cases} {hit} ELSE 'skip' END AS outcome, reason,
               CAST(count(*) AS BIGINT) AS n_rows
        FROM judged GROUP BY 1, 2"""


def rejects_sql(ctes: str, row_id: str, order: str = "_o1, _o2, _o3") -> str:
    return f"""WITH {ctes}, {RANKED.format(order=order)}
        SELECT {row_id} AS row_id, COALESCE(r, 'repeat_in_file') AS reason FROM c2 WHERE r IS NOT NULL OR rn > 1"""
