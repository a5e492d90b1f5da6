"""Export- and target-shaped frames made from the supplied tables.

Each adapter is one SELECT that Spark and DuckDB both understand, so the two
engines start from the same rows. They read whole tables; dirt (blank cells, bad
ids, voids, repeats) is put into cells, no row is left out to keep a check small.

Columns ``_o1 ..`` are the row order of the export. Spark gets them as one struct
``_row_ord``; the oracles order by them.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaseload.sources.exports import ROW_ORDER

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)


def text(x: str) -> str:
    return f"CAST({x} AS STRING)"


def pad(x: str) -> str:
    return f"lpad({text(x)}, 2, '0')"


def iso(x: str) -> str:
    return f"({text(f'year({x})')} || '-' || {pad(f'month({x})')} || '-' || {pad(f'day({x})')})"


def us(x: str, sep: str = "/") -> str:
    return f"({text(f'month({x})')} || '{sep}' || {text(f'day({x})')} || '{sep}' || {text(f'year({x})')})"


def clock(x: str) -> str:
    return f"({pad(f'hour({x})')} || ':' || {pad(f'minute({x})')} || ':' || {pad(f'second({x})')})"


def dollars(cents: str, below: int) -> str:
    """Dollar text made of whole numbers only, so that no engine has to round a double."""
    return f"({text(f'{cents} % {below}')} || '.' || {pad(f'{cents} % 100')})"


def money(x: str, scale: int = 2) -> str:
    return text(f"CAST({x} AS DECIMAL(18,{scale}))")


def huge(key: str) -> str:
    """Amounts that a double cannot hold to the cent, or that no bigint holds in cents."""
    return (
        f"CASE {key} % 4 WHEN 0 THEN '99999999999999999999' WHEN 1 THEN '1e30' WHEN 2 THEN '90071992547409.93' "
        "ELSE '90071992547409.95' END"
    )


LINE_ID = (
    "(l_orderkey * 100000 + l_linenumber * 10000 "
    "+ (l_partkey * 31 + year(l_shipdate) * 366 + dayofyear(l_shipdate)) % 10000)"
)
PRICE_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
TOTAL_CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"
PAY_ID = "(l_orderkey * 10 + l_linenumber)"
LINE_ORDER = f"{LINE_ID} AS _o1, l_suppkey AS _o2, {PRICE_CENTS} AS _o3"
UNIT_OF_ORDER = "(o_orderkey * 7) % 2500"
NOON = "' 12:30:15'"

ADAPTERS: dict[str, str] = {
    # -- stored tables ---------------------------------------------------------
    "t_customers": f"""
        SELECT c_custkey + 1 AS id,
               CASE WHEN c_custkey % 10 = 0 THEN 'N' || {text('c_custkey')} ELSE {text('c_custkey')} END AS external_id,
               CASE WHEN c_custkey % 4 = 1 THEN 'Solo' || {text('c_custkey')}
                    ELSE 'Fam' || {text('c_custkey - c_custkey % 16')} END AS last_name,
               CASE WHEN c_custkey % 9 = 8 THEN NULL ELSE {text('c_nationkey')} || ' Nation Road' END AS address1,
               c_mktsegment AS company_name,
               CAST(1 AS BIGINT) AS organization_id, CAST(4 AS BIGINT) AS location_id,
               CAST(CASE WHEN c_nationkey = 7 THEN NULL ELSE c_nationkey END AS BIGINT) AS external_employee_id,
               CAST(5 AS BIGINT) AS created_by
        FROM {{customer}}""",
    "t_units": f"""
        SELECT p_partkey + 1 AS id, 'U' || {text('p_partkey')} AS unit_number,
               CAST(1 AS BIGINT) AS organization_id, CAST(4 AS BIGINT) AS location_id,
               p_brand AS building, CAST(p_retailprice AS DECIMAL(12,2)) AS standard_rate,
               p_size > 25 AS reserved, CAST(3 AS BIGINT) AS created_by
        FROM {{part}}""",
    "t_sizes": f"""
        SELECT DISTINCT CAST(p_size AS BIGINT) AS id, {text('p_size')} || ' X 10' AS value FROM {{part}}
        UNION ALL SELECT DISTINCT CAST(9000 AS BIGINT), '0 x 0' FROM {{part}}""",
    "t_charges": f"""
        SELECT {LINE_ID} * 1000 + l_suppkey % 1000 AS id, {text(LINE_ID)} AS external_charge_id,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' AND l_linenumber < 3 THEN NULL
                    ELSE l_suppkey + 1 END AS customer_id,
               CAST(CASE l_linenumber WHEN 1 THEN 3 WHEN 2 THEN 1 WHEN 3 THEN 21 WHEN 4 THEN 13 ELSE 40 END AS BIGINT)
                   AS charge_type_id,
               CASE WHEN l_orderkey % 20 = 0 THEN 0 - {PRICE_CENTS} ELSE {PRICE_CENTS} END AS amount_in_cents
        FROM {{lineitem}}""",
    "t_charges_loaded": f"""
        SELECT {text(LINE_ID)} AS external_charge_id, {PRICE_CENTS} AS amount_in_cents
        FROM {{lineitem}} WHERE l_linestatus = 'O' AND l_returnflag = 'A'""",
    "t_payments": f"""
        SELECT {LINE_ID} * 1000 + l_suppkey % 1000 AS id, {text(PAY_ID)} AS external_payment_id, l_shipdate AS payment_date,
               CAST(99 + l_linenumber AS BIGINT) AS payment_method_type_id,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey + 1 END AS invoice_id,
               CASE WHEN l_returnflag = 'N' THEN {PRICE_CENTS} ELSE {PRICE_CENTS} * 3 END AS amount_in_cents,
               CASE WHEN l_tax = 0.01 THEN NULL ELSE l_suppkey END AS external_employee_id,
               CAST(5 AS BIGINT) AS created_by
        FROM {{lineitem}}""",
    "t_payments_loaded": f"""
        SELECT DISTINCT {text(PAY_ID)} AS external_id FROM {{lineitem}} WHERE l_linestatus = 'O' AND l_tax = 0.0""",
    "t_methods": """
        SELECT DISTINCT CAST(99 + l_linenumber AS BIGINT) AS id, 'Method ' || CAST(l_linenumber AS STRING) AS name
        FROM {lineitem} WHERE l_linenumber < 7""",
    "t_receipts": f"""
        SELECT 'SL-' || {text('l_orderkey')} || '-' || {text(PAY_ID)} AS receipt_number
        FROM {{lineitem}} WHERE l_returnflag = 'A' AND l_linestatus = 'O' AND l_tax = 0.02""",
    "t_invoices": f"""
        SELECT o_orderkey + 1 AS id, {text('o_orderkey')} AS external_invoice_id,
               CASE WHEN o_orderkey % 15 = 0 THEN 0 ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS total_in_cents,
               CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderdate + INTERVAL 30 DAY AS DATE) END AS due_date,
               'UNPAID' AS status
        FROM {{orders}}""",
    "t_leases": f"""
        SELECT o_orderkey + 1 AS id, o_custkey + 1 AS customer_id, {UNIT_OF_ORDER} + 1 AS unit_id,
               CAST(o_orderdate AS DATE) AS move_in_date,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate + INTERVAL 90 DAY AS DATE) END AS move_out_date,
               CASE WHEN o_orderstatus = 'F' THEN 'TERMINATED' ELSE 'ACTIVE' END AS status
        FROM {{orders}} WHERE o_totalprice > 250000""",
    "t_links": f"""
        SELECT o_custkey + 1 AS customer_id, {UNIT_OF_ORDER} + 1 AS unit_id, CAST(o_orderdate AS DATE) AS lease_date,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate + INTERVAL 90 DAY AS DATE) END AS move_out_date
        FROM {{orders}} WHERE o_totalprice > 250000""",
    "t_schedules": """
        SELECT o_orderkey + 1 AS rental_agreement_id FROM {orders}
        WHERE o_totalprice > 450000""",
    "t_profiles": f"""
        SELECT o_orderkey + 1 AS id, o_custkey + 1 AS customer_id, lpad({text('o_orderkey % 40')}, 4, '0') AS card_last4,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE month(o_orderdate) END AS card_exp_month,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE year(o_orderdate) END AS card_exp_year
        FROM {{orders}} WHERE o_orderpriority = '1-URGENT'""",
    "t_users": f"""
        SELECT s_suppkey + 1000 AS id, CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE s_suppkey END AS external_id
        FROM {{supplier}}""",
    # -- exports ---------------------------------------------------------------
    "x_tenants": f"""
        SELECT CASE WHEN o_orderkey % 97 = 0 THEN 'abc' ELSE {text('o_orderkey')} || '.0' END AS LEDGERID,
               {text('o_custkey')} || '.0' AS TENANTID, ' U' || {text(UNIT_OF_ORDER)} || ' ' AS SUNITNAME,
               o_orderkey AS _o1, 0 AS _o2
        FROM {{orders}}
        UNION ALL
        SELECT {text('o_orderkey')}, CASE WHEN o_orderpriority = '5-LOW' THEN 'x' ELSE {text('o_custkey + 1')} END,
               CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE 'U' || {text(UNIT_OF_ORDER + ' + 1')} END,
               o_orderkey, 1
        FROM {{orders}} WHERE o_orderstatus = 'P'""",
    "x_charge_types": f"""
        SELECT DISTINCT CASE l_linenumber WHEN 1 THEN '3' WHEN 2 THEN '1' WHEN 3 THEN '21.0' WHEN 4 THEN '13'
                             WHEN 5 THEN '40' WHEN 6 THEN '41' ELSE NULL END AS ID,
               {text('l_linenumber')} || '.0' AS CHARGEDESCID, l_linenumber AS _o1
        FROM {{lineitem}}""",
    "x_charges": f"""
        SELECT CASE WHEN l_tax = 0.08 AND l_discount = 0.1 THEN ' ' ELSE {text(LINE_ID)} || '.0' END AS CHARGEID,
               CASE WHEN l_tax = 0.07 AND l_discount = 0.0 THEN 'n/k' ELSE {text('l_linenumber')} END AS CHARGEDESCID,
               {text('l_orderkey')} || '.0' AS LEDGERID,
               CASE WHEN l_tax = 0.06 AND l_discount = 0.06 THEN {huge('l_orderkey')}
                    ELSE CASE WHEN l_discount = 0.1 THEN '-' ELSE '' END || {money('l_extendedprice * (1 - l_discount)', 4)} END AS DCAMT,
               CASE WHEN l_linenumber = 2 THEN 'soon' ELSE {us('l_shipdate')} || {NOON} END AS DCHGSTRT,
               CASE WHEN l_linenumber IN (2, 3) AND l_tax < 0.02 THEN NULL
                    ELSE {iso('l_shipdate')} || ' 8:05:09.25' END AS DCREATED,
               CASE WHEN l_tax > 0.05 THEN {us('l_shipdate')} || ' 3:15:00 PM' END AS DUPDATED,
               CASE WHEN l_returnflag = 'A' THEN ' Rent ' WHEN l_returnflag = 'N' THEN 'nan' END AS SCHGDESC,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN {us('l_shipdate')} END AS DDELETED,
               {text('l_suppkey')} || '.0' AS EMPLOYEEID, {LINE_ORDER}
        FROM {{lineitem}}""",
    "x_payments": f"""
        SELECT CASE WHEN l_tax = 0.08 AND l_discount = 0.1 THEN NULL ELSE {text(PAY_ID)} || '.0' END AS PAYMENTID,
               CASE WHEN l_tax = 0.08 AND l_discount = 0.09 THEN ' ' ELSE {text('l_orderkey')} || '.0' END AS LEDGERID,
               {text(LINE_ID)} AS CHARGEID,
               CASE WHEN l_tax = 0.07 AND l_discount = 0.05 THEN 'cash' ELSE {text('99 + l_linenumber')} || '.0' END AS PMTTYPEID,
               CASE WHEN l_discount = 0.0 THEN '0.00' WHEN l_tax = 0.06 AND l_discount = 0.06 THEN {huge('l_orderkey')}
                    ELSE CASE WHEN l_discount = 0.1 THEN '-' ELSE '' END || {money('l_extendedprice * l_discount', 4)} END AS DCPMTAMT,
               CASE l_linenumber WHEN 1 THEN {us('l_shipdate')} WHEN 2 THEN {iso('l_shipdate')} || {NOON}
                    WHEN 3 THEN {us('l_shipdate', '-')} WHEN 4 THEN {us('l_shipdate')} || ' 7:45'
                    WHEN 5 THEN '3/3/1969' WHEN 6 THEN 'nat' ELSE NULL END AS DPMT,
               CASE WHEN l_linenumber = 7 AND l_tax > 0.04 THEN '31/31/2020'
                    WHEN l_linenumber = 1 THEN '' ELSE {iso('l_shipdate')} || ' 9:01:02.5' END AS DCREATED,
               CASE WHEN l_tax > 0.03 THEN ' CK' || {text('l_partkey')} ELSE 'nan' END AS SCHECKNUM,
               CASE WHEN l_returnflag = 'A' THEN 'True' WHEN l_returnflag = 'N' THEN '0' END AS BNSF,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN {us('l_shipdate')} END AS DDELETED,
               CASE WHEN l_tax < 0.04 THEN {text('l_partkey')} || '.0' END AS RECEIPTID,
               {text('l_suppkey')} AS EMPLOYEEID, {LINE_ORDER}
        FROM {{lineitem}}""",
    "x_credits": f"""
        SELECT CASE WHEN l_tax = 0.05 AND l_linenumber = 2 THEN 'C' || {text(LINE_ID)} ELSE {text(LINE_ID)} || '.0' END AS CREDITID,
               CASE WHEN l_tax = 0.08 AND l_discount = 0.03 THEN ' '
                    WHEN l_tax = 0.08 AND l_discount = 0.04 THEN 'void' ELSE {text('l_orderkey')} END AS LEDGERID,
               CASE WHEN l_tax = 0.04 AND l_discount = 0.06 THEN {huge('l_orderkey')}
                    ELSE CASE WHEN l_returnflag = 'R' THEN '-' ELSE '' END || {money('l_extendedprice * l_discount', 4)} END AS DCCREDITAMT,
               CASE WHEN l_tax = 0.06 THEN '1/1/1900' ELSE {us('l_shipdate')} END AS DCREDIT,
               CASE WHEN l_tax = 0.03 THEN '1900-01-01' ELSE {iso('l_shipdate')} || 'T10:11:12' END AS DCREATED,
               CASE l_linenumber WHEN 1 THEN 'Waived Current Late Fee 1. ' WHEN 2 THEN 'waived current late fee 2.'
                    WHEN 3 THEN ' RESERVATION FEE' ELSE 'Goodwill' END AS SMEMO,
               CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN ' True' WHEN l_returnflag = 'N' THEN 'False' END AS BNONPOSTING,
               CASE WHEN l_discount = 0.07 THEN {us('l_shipdate')} END AS DDELETED,
               CASE WHEN l_linenumber = 3 AND l_tax > 0.06 THEN {text(PAY_ID)} || '.0' END AS PAYMENTID,
               {text('l_suppkey')} AS EMPLOYEEID, {LINE_ORDER}
        FROM {{lineitem}}""",
    "x_invoices": f"""
        SELECT {text('l_orderkey')} || '.0' AS INVOICEID,
               CASE WHEN l_orderkey % 31 = 0 THEN NULL ELSE {text('l_orderkey + 500000')} END AS IINVOICENUM,
               CASE WHEN l_orderkey % 37 = 0 THEN NULL WHEN l_tax = 0.04 THEN '9' || {text(LINE_ID)}
                    ELSE {text(LINE_ID)} || '.0' END AS CHARGEID,
               CASE WHEN l_orderkey % 41 = 0 THEN 'unknown' ELSE {us('l_shipdate')} END AS DINVOICED,
               CASE WHEN l_orderkey % 43 = 0 THEN '' ELSE {iso('l_shipdate + INTERVAL 10 DAY')} END AS DDUE,
               CASE WHEN l_returnflag = 'A' THEN {text(PAY_ID)} || '.0' END AS PAYMENTID,
               {text('l_suppkey')} AS EMPLOYEEID, {LINE_ORDER}
        FROM {{lineitem}}""",
    "x_receipts": f"""
        SELECT {text(LINE_ID)} AS RECEIPTID,
               CASE WHEN l_tax = 0.08 AND l_discount = 0.01 THEN 'none so far' ELSE {text('l_partkey')} || '.0' END AS TENANTID,
               CASE WHEN l_discount = 0.0 THEN NULL WHEN l_tax = 0.06 AND l_discount = 0.06 THEN {huge('l_orderkey')}
                    ELSE {money('l_extendedprice - 20000')} END AS DCAMT,
               CASE WHEN l_linenumber = 6 THEN '' ELSE {us('l_shipdate')} || ' 1:02:03 AM' END AS DRCPT,
               CASE WHEN l_tax = 0.08 AND l_discount = 0.02 THEN NULL ELSE ' ' || {text('l_orderkey')} END AS IRECEIPTNUM,
               CASE WHEN l_tax = 0.07 AND l_discount = 0.02 THEN {text(PAY_ID)} || '77' ELSE {text(PAY_ID)} END AS PAYMENTID,
               {text('l_suppkey')} AS EMPLOYEEID, {LINE_ORDER}
        FROM {{lineitem}}""",
    "x_gate": f"""
        SELECT CASE WHEN event_id % 50 = 0 THEN 'just now' WHEN event_id % 53 = 0 THEN ''
                    ELSE {us('ts')} || ' ' || {clock('ts')} END AS OCCURRED,
               CASE WHEN event_type = 'view' THEN ' Granted ' WHEN event_type = 'click' THEN '' ELSE event_type END AS DESCRIPTION,
               CASE WHEN event_type = 'error' THEN 'Gate with a rather long name and number ' || {text('event_id')}
                    ELSE 'Gate ' || {text('user_id')} END AS ACCESSPOINTNAME,
               CASE WHEN event_type = 'signup' THEN '' ELSE 'First' || {text('user_id')} END AS ACCESSORFIRSTNAME,
               CASE WHEN event_type IN ('purchase', 'signup') AND value > 50 THEN NULL
                    WHEN event_type = 'view' THEN 'Last' || repeat('x', 120) ELSE 'Last' || {text('user_id')} END AS ACCESSORLASTNAME,
               event_id AS _o1
        FROM {{events}}""",
    "x_tenancy": f"""
        SELECT CASE WHEN o_orderkey % 29 = 0 THEN {text('o_custkey')} || '.0' ELSE {text('o_custkey')} END AS TENANTID,
               ' U' || {text(UNIT_OF_ORDER)} AS SUNITNAME, {text('o_orderkey')} AS LEDGERID,
               CASE WHEN o_orderkey % 61 = 0 THEN 'NaT' ELSE {us('o_orderdate')} END AS DMOVEDIN,
               CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE {iso('o_orderdate + INTERVAL 2 DAY')} END AS DLEASE,
               CASE WHEN o_orderkey % 67 = 0 THEN '' ELSE {us('o_orderdate + INTERVAL 60 DAY')} END AS DPAIDTHRU,
               CASE WHEN o_orderstatus = 'F' THEN {us('o_orderdate + INTERVAL 90 DAY')} || ' 17:00:00'
                    WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'nat' END AS DMOVEDOUT,
               CASE WHEN o_orderpriority = '3-MEDIUM' THEN {us('o_orderdate - INTERVAL 5 DAY')}
                    WHEN o_orderpriority = '5-LOW' THEN {us('o_orderdate + INTERVAL 85 DAY')} END AS DSCHEDOUT,
               CASE WHEN o_orderkey % 71 = 0 THEN NULL WHEN o_orderkey % 73 = 0 THEN 'free'
                    WHEN o_orderkey % 79 = 0 THEN {huge('o_orderkey')}
                    ELSE '$' || {dollars(TOTAL_CENTS, 397)} END AS DCRENT,
               CASE WHEN o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED') THEN '0'
                    ELSE {dollars(TOTAL_CENTS, 401)} END AS DCSCHEDRENT,
               CASE WHEN o_orderpriority = '2-HIGH' THEN '1,' || {text('200 + o_orderkey % 700')} || '.50' END AS DCSECDEPPAID,
               CASE WHEN o_orderstatus = 'O' THEN '12.125' WHEN o_orderstatus = 'P' THEN '0' END AS DCINSURPREMIUM,
               CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE ' G' || {text('o_orderkey')} || 'ABCDEFGH' END AS SACCESSCODE,
               CASE WHEN o_orderkey % 11 = 0 THEN '9' WHEN o_orderkey % 13 = 0 THEN 'soon'
                    ELSE {text('3 + o_orderkey % 4')} || '.0' END AS BILLINGFREQID,
               CASE WHEN o_orderkey % 3 = 0 THEN '15' WHEN o_orderkey % 3 = 1 THEN '0' END AS IPROCESSDAYOFMONTH,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN {us('o_orderdate')} END AS DDELETED2,
               {text('o_custkey % 25')} AS EMPLOYEEID, o_orderkey AS _o1
        FROM {{orders}}""",
    "x_rent_roll": f"""
        SELECT ' U' || {text('p_partkey')} AS UNIT,
               CASE WHEN p_size < 10 THEN '' WHEN p_size < 15 THEN 'x' WHEN p_size < 20 THEN '0'
                    ELSE {text('p_size - 19')} || '.0' END AS "CHARGE DAY", p_partkey AS _o1
        FROM {{part}}""",
    "x_customers": f"""
        SELECT CASE WHEN c_custkey % 33 = 0 THEN ' ' ELSE {text('c_custkey')} END AS TENANTID,
               CASE WHEN c_nationkey = 3 THEN 'nan' ELSE ' First' || {text('c_custkey % 40')} END AS SFNAME,
               CASE WHEN c_nationkey > 12 THEN 'Q ' ELSE '' END AS SMI, 'Last' || {text('c_custkey')} AS SLNAME,
               c_mktsegment AS SCOMPANY, {text('c_nationkey')} || ' Road' AS SADDR1, 'none' AS SADDR2,
               'City ' || {text('c_nationkey')} AS SCITY, 'ST' AS SREGION, {text('10000 + c_custkey')} AS SPOSTALCODE,
               'US' AS SCOUNTRY, '555-' || {text('c_custkey')} AS SPHONE,
               CASE WHEN c_nationkey < 5 THEN 'Alt' END AS SFNAMEALT, 'Z' AS SMIALT, '' AS SLNAMEALT,
               '' AS SADDR1ALT, '' AS SADDR2ALT, '' AS SCITYALT, '' AS SREGIONALT, '' AS SPOSTALCODEALT,
               '' AS SCOUNTRYALT, {text('c_nationkey')} AS SPHONEALT,
               'c' || {text('c_custkey')} || '@example.org' AS SEMAIL, NULL AS SEMAILALT, '' AS SMOBILE,
               'G' || {text('c_custkey')} AS SACCESSCODE, 'D' || {text('c_custkey')} AS SLICENSE, 'NC' AS SLICREGION,
               {text('c_nationkey')} || '.0' AS EMPLOYEEID, c_custkey AS _o1, 0 AS _o2
        FROM {{customer}}
        UNION ALL
        SELECT {text('c_custkey')}, 'Again', 'B', 'Later' || {text('c_custkey')}, 'x', 'y', '', '', '', '', '', '',
               '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '1', c_custkey, 1
        FROM {{customer}} WHERE c_acctbal < 1000""",
    "x_former": f"""
        SELECT 'U' || {text(UNIT_OF_ORDER)} AS UNITNAME, 'First' || {text('o_custkey % 50')} AS FIRSTNAME, 'M' AS MI,
               CASE WHEN o_orderkey % 59 = 0 THEN ' ' ELSE 'Last' || {text('o_custkey')} END AS LASTNAME,
               'Co' AS COMPANY, {text('o_custkey')} || ' Street' AS ADDRESS1, '' AS ADDRESS2, 'Town' AS CITY,
               'ST' AS STATE, '27000' AS ZIPCODE,
               CASE WHEN o_custkey % 3 = 0 THEN 'p' || {text('o_custkey')} || '@example.org' END AS EMAIL,
               CASE WHEN o_custkey % 3 = 1 THEN ' 555' || {text('o_custkey')} END AS PHONE,
               CASE WHEN o_custkey % 3 = 2 THEN '777' || {text('o_custkey')} END AS MOBILE, 'G' AS GATECODE,
               {us('o_orderdate')} AS DATEMOVEDIN,
               CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE {iso('o_orderdate + INTERVAL 90 DAY')} END AS DATEMOVEDOUT,
               CASE o_orderstatus WHEN 'F' THEN ' 0' WHEN 'O' THEN '2' ELSE
                    CASE WHEN o_orderpriority = '1-URGENT' THEN '0.0' ELSE '' END END AS ACTIVELEDGERS,
               CASE WHEN o_orderkey % 47 = 0 THEN NULL ELSE {text('o_custkey')} || '.0' END AS TENANTID,
               '3' AS EMPLOYEEID, o_orderkey AS _o1
        FROM {{orders}}""",
    "x_units": f"""
        SELECT CASE WHEN p_partkey % 41 = 0 THEN 'NaN' ELSE ' U' || {text('p_partkey')} END AS UNITNAME,
               p_brand AS BLDG,
               CASE p_type WHEN 'SMALL' THEN ' Climate Control' WHEN 'LARGE' THEN 'RV Parking' WHEN 'PROMO' THEN 'Apartment'
                    WHEN 'MEDIUM' THEN 'climate' WHEN 'ECONOMY' THEN 'Boat Parking' ELSE 'Locker' END AS TYPE,
               CASE WHEN p_size > 30 THEN 'Interior ' ELSE 'Exterior' END AS "ENTRY LOCATION",
               CASE p_size % 6 WHEN 0 THEN 'Ground Floor DriveUp' WHEN 1 THEN 'driveup covered exterior parking'
                    WHEN 2 THEN 'Multi-Floor/Level Elevator Accessible' WHEN 3 THEN 'multi-floor/level elevator no-accessible'
                    WHEN 4 THEN 'by boat' ELSE '' END AS "UNIT ACCESS",
               CASE p_size % 4 WHEN 0 THEN '1' WHEN 1 THEN '2.0' WHEN 2 THEN '-1' ELSE NULL END AS FLOOR,
               CASE p_size % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'n' WHEN 2 THEN 'maybe' WHEN 3 THEN 'TRUE' ELSE '' END AS "POWER (YES/NO)",
               'yes' AS POWER_ELECTRICALOUTLET,
               CASE p_size % 4 WHEN 0 THEN 'Hallway' WHEN 1 THEN 'Inside Unit' WHEN 2 THEN 'no' ELSE 'lamp' END AS POWER_LIGHTS,
               CASE p_size % 7 WHEN 0 THEN 'Continuous' WHEN 1 THEN 'NO' WHEN 2 THEN '1.9' WHEN 3 THEN '24' WHEN 4 THEN '25'
                    WHEN 5 THEN '0.5' ELSE '' END AS POWER_TIMER_HR,
               '24/7 ' AS "UNIT ACCESS HOURS",
               CASE p_size % 6 WHEN 0 THEN 'Pad Lock' WHEN 1 THEN 'padlock' WHEN 2 THEN 'Smart Lock' WHEN 3 THEN 'RFID'
                    WHEN 4 THEN 'bluetooth' ELSE 'chain' END AS ENTRYLOCK,
               CASE p_size % 4 WHEN 0 THEN 'RollUp' WHEN 1 THEN 'roll up' WHEN 2 THEN 'Swing' ELSE 'curtain' END AS DOORTYPE,
               'no' AS ALARM, CASE p_size % 3 WHEN 0 THEN 'Y' WHEN 1 THEN '' ELSE 'no' END AS ADA, p_name AS AREA,
               CASE WHEN p_size % 2 = 0 THEN {text('p_size')} || ' * 10' WHEN p_size % 5 = 0 THEN '99x99'
                    ELSE {text('p_size')} || 'x10' END AS UNITSIZE,
               {money('p_retailprice')} || '5' AS STANDARDRATE,
               CASE WHEN p_size = 7 THEN '$10' ELSE '1.125' END AS PUSHRATE, '' AS WEEKLYRATE,
               CASE WHEN p_size % 5 = 0 THEN 'yes' END AS RENTABLE, CASE WHEN p_size % 3 = 0 THEN 'Y' END AS RENTED,
               CASE WHEN p_size % 7 = 0 THEN 'yes' END AS MAINTENANCE, CASE WHEN p_size % 2 = 0 THEN 'Yes ' END AS RESERVED,
               '' AS "ON-SITE RESIDENT", 'no' AS "BOX TRUCK RENTAL",
               CASE p_size % 5 WHEN 0 THEN 'POD' WHEN 1 THEN 'Shipping Container' WHEN 2 THEN 'no'
                    WHEN 3 THEN 'tent' ELSE '' END AS "MOBILE UNIT",
               p_partkey AS _o1, 0 AS _o2
        FROM {{part}}
        UNION ALL
        SELECT 'U' || {text('p_partkey')}, 'Second', 'Locker', 'Interior', '', '3', 'no', 'no', 'no', 'no', '', 'rfid', 'swing',
               'yes', 'yes', 'B', '5x5', '77.005', '3', '4', '', '', 'yes', '', 'no', 'yes', 'no', p_partkey, 1
        FROM {{part}} WHERE p_brand = 'Brand#5' OR p_brand = 'Brand#15'""",
    "x_cards": f"""
        SELECT CASE WHEN o_orderkey % 19 = 0 THEN 'NoComma' WHEN o_orderkey % 23 = 0 THEN 'Stranger, A'
                    WHEN o_custkey % 4 = 1 THEN 'SOLO' || {text('o_custkey')} || ', Ann'
                    ELSE 'fam' || {text('o_custkey - o_custkey % 16')} || ' , Bo' END AS Name,
               '**** **** **** ' || lpad({text('o_orderkey % 40')}, 4, '0') AS CardNumber,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Master Card' WHEN '2-HIGH' THEN 'VISA'
                    WHEN '3-MEDIUM' THEN 'American Express' WHEN '4-NOT SPECIFIED' THEN 'Diners Club' ELSE '' END AS CardType,
               CASE WHEN o_orderstatus = 'P' THEN 'never' ELSE {us('o_orderdate')} END AS ExpirationDate,
               'Holder ' || {text('o_custkey')} AS NameOnCard, ' ' || {text('o_custkey % 25')} || ' NATION road' AS Address,
               CASE WHEN o_orderstatus = 'O' THEN '27001' END AS ZipCode, o_orderkey AS _o1
        FROM {{orders}}""",
    "x_balances": f"""
        SELECT {text('c_custkey')} AS TENANTID,
               CASE WHEN c_custkey % 37 = 0 THEN {huge('c_custkey')} ELSE {money('c_acctbal')} END AS DCRENTBAL,
               CASE WHEN c_nationkey > 5 THEN '10.005' END AS DCLATEFEE1BAL, '1' AS DCLATEFEE2BAL, NULL AS DCLATEFEE3BAL,
               'x' AS DCLATEFEE4BAL, '' AS DCLATEFEE5BAL, '2.5' AS DCNSFBAL,
               CASE WHEN c_nationkey = 9 THEN '-9000' END AS DCADMINFEEBAL, '3' AS DCRECCHG8BAL,
               {dollars('CAST(round(abs(c_acctbal) * 100) AS BIGINT)', 97)} AS DCCREDITBAL,
               CASE WHEN c_nationkey < 20 THEN '2/' || {text('1 + c_nationkey')} || '/2020' END AS DPMTLAST,
               CASE WHEN c_nationkey = 2 THEN NULL ELSE '$1,' || {text('100 + c_nationkey')} || '.55' END AS DCPMTLASTAMT,
               c_custkey AS _o1
        FROM {{customer}}""",
    # -- legacy tables ---------------------------------------------------------
    "l_sites": """SELECT r_regionkey AS SiteID, 'L' || CAST(r_regionkey AS STRING) AS sLocationCode, r_name AS sSiteName FROM {region}""",
    "l_units": f"""
        SELECT p_partkey AS UnitID, 'U' || {text('p_partkey')} AS sUnitName,
               CASE WHEN p_size > 40 THEN 1 ELSE 0 END AS bPermanent FROM {{part}}""",
    "l_ledgers": """
        SELECT o_orderkey AS LedgerID, o_orderkey % 200 AS UnitID,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END AS SiteID, CAST(o_orderdate AS DATE) AS dMovedIn,
               CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate + INTERVAL 90 DAY AS DATE) END AS dMovedOut,
               CASE WHEN o_orderpriority = '5-LOW' THEN CAST(o_orderdate AS DATE) END AS dDeleted
        FROM {orders}""",
    "l_access": f"""
        SELECT o_orderkey AS LedgerID, o_custkey AS TenantID,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END AS SiteID,
               CASE WHEN o_totalprice < 50000 THEN 0 ELSE 1 END AS bPrimary, 'G' || {text('o_orderkey')} AS sAccessCode
        FROM {{orders}}""",
    "l_tenants": f"""
        SELECT c_custkey AS TenantID, 'Mx' AS sMrMrs, CASE WHEN c_nationkey = 4 THEN NULL ELSE 'F' || {text('c_custkey')} END AS sFName,
               'M' AS sMI, 'L' || {text('c_custkey')} AS sLName, c_mktsegment AS sCompany, 'A1' AS sAddr1, 'A2' AS sAddr2,
               'City' AS sCity, 'ST' AS sRegion, '27000' AS sPostalCode, 'e@example.org' AS sEmail, '555' AS sPhone,
               CASE WHEN c_nationkey > 20 THEN NULL ELSE '777' || {text('c_custkey')} END AS sMobile,
               DATE '1980-01-01' AS dDOB, 'T' || {text('c_nationkey')} AS sTaxID
        FROM {{customer}}""",
    "l_credits": f"""
        SELECT {LINE_ID} AS CreditID, l_linenumber AS MemoID, l_orderkey AS LedgerID, {PRICE_CENTS} AS cents FROM {{lineitem}}""",
    "l_memos": """
        SELECT DISTINCT l_linenumber AS MemoID, 'Memo ' || CAST(l_linenumber AS STRING) AS SMemo FROM {lineitem}
        WHERE l_linenumber < 6""",
    "l_invoices": """SELECT o_orderkey AS InvoiceID, o_custkey AS CustomerRef, o_orderpriority AS kind FROM {orders}""",
    "l_details": f"""SELECT l_orderkey AS InvoiceID, {LINE_ID} AS ChargeID, {PRICE_CENTS} AS cents FROM {{lineitem}}""",
    # -- run history: one JSON document per event -------------------------------
    "x_run_texts": f"""
        SELECT '{{{{"runs":[{{{{"run_id":"r' || {text('event_id')} || '","migration_type":"' || event_type ||
               '","files":["' || {text('user_id')} || '.csv"],"dry_run":' ||
               CASE WHEN value > 90 THEN 'true' ELSE 'false' END || ',"started_at":"' || {iso('ts')} || 'T' || {clock('ts')} ||
               '","finished_at":"' || {iso('ts + INTERVAL 1 DAY')} || 'T' || {clock('ts')} || '","status":"' ||
               CASE WHEN event_type = 'error' THEN 'error' WHEN event_type = 'view' THEN 'running' ELSE 'success' END ||
               '","exit_code":0}}}}]}}}}' AS doc, event_id AS _o1
        FROM {{events}}""",
}

# The stored side of several plans is a part of all orders; as the subject of a query they are whole.
for _name in ("leases", "links", "profiles"):
    ADAPTERS[f"s_{_name}"] = ADAPTERS[f"t_{_name}"].rsplit("WHERE", 1)[0]

# Exports in which some filled date cells hold no date.
ADAPTERS["x_credits_odd"] = ADAPTERS["x_credits"].replace("THEN '1/1/1900' ELSE", "THEN 'last week' ELSE").replace(
    "THEN '1900-01-01' ELSE", "THEN '32/32/2020' ELSE"
)
ADAPTERS["x_receipts_odd"] = ADAPTERS["x_receipts"].replace("CASE WHEN l_linenumber = 6 THEN '' ELSE", "CASE WHEN l_linenumber = 6 THEN 'paid in cash' ELSE")

# One day in the spellings people and machines use, by the order's key.
_MONTH3 = "substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3 * month(o_orderdate) - 2, 3)"
_MONTHS = "January February March April May June July August September October November December".split()
_MONTH = "CASE month(o_orderdate) " + " ".join(f"WHEN {n} THEN '{m}'" for n, m in enumerate(_MONTHS, 1)) + " END"
_DAY, _YEAR = text("day(o_orderdate)"), text("year(o_orderdate)")
_HOUR = "(1 + o_orderkey % 12)"
ADAPTERS["x_spelled"] = f"""
    SELECT CASE o_orderkey % 12
               WHEN 0 THEN {_MONTH3} || ' ' || {_DAY} || ', ' || {_YEAR}
               WHEN 1 THEN {_DAY} || ' ' || {_MONTH} || ' ' || {_YEAR}
               WHEN 2 THEN {_DAY} || ' ' || {_MONTH} || ' ' || {_YEAR} || ' ' || {text(_HOUR)} || ':04 PM'
               WHEN 3 THEN {iso('o_orderdate')} || 'T0' || {text('o_orderkey % 10')} || ':05:06+00:00'
               WHEN 4 THEN {iso('o_orderdate')} || ' 11:05:06.25-0530'
               WHEN 5 THEN {pad('day(o_orderdate)')} || '-' || upper({_MONTH3}) || '-' || {_YEAR}
               WHEN 6 THEN {_YEAR} || '/' || {text('month(o_orderdate)')} || '/' || {_DAY}
               WHEN 7 THEN replace({iso('o_orderdate')}, '-', '')
               WHEN 8 THEN {us('o_orderdate')} || ' ' || {text(_HOUR)} || ' am'
               WHEN 9 THEN 'Monday, ' || {_MONTH} || ' ' || {_DAY} || 'th, ' || {_YEAR}
               WHEN 10 THEN {_MONTH} || ' soon' ELSE 'n/a ' || {_YEAR} END AS SPELLED,
           CAST(o_orderdate AS DATE) AS day, o_orderkey AS _o1
    FROM {{orders}}"""

_UPPER_EXPORTS = re.compile(r"^_o[0-9]+$")


def sql_for(name: str) -> str:
    """The adapter as DuckDB reads it: base tables under their own names."""
    return ADAPTERS[name].format(**{t: t for t in BASE_TABLES})


def with_adapters(names: tuple[str, ...], body: str) -> str:
    """An oracle: the adapters it reads as common table expressions, then its own query."""
    ctes = ",\n".join(f"{n} AS ({sql_for(n)})" for n in names)
    return f"WITH {ctes}{', ' if body.lstrip().startswith('WITH ') else ' '}" + (
        body.lstrip()[5:] if body.lstrip().startswith("WITH ") else body
    )


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table. Where a wide one comes as a few row groups, which feed a few cores
    only, it is spread; Spark's own setting says over how many tasks. A table whose splits
    feed all cores is read as it is: to spread it would send all of it through a shuffle."""
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    wide = name in ("lineitem", "orders", "events")
    return table.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))) if wide and not _feeds_all(table) else table


def _feeds_all(table: DataFrame) -> bool:
    """Whether every core has a split with rows; told by the footers, no column is read."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    if table.select().rdd.getNumPartitions() < cores:
        return False
    return table.select(F.spark_partition_id().alias("part")).distinct().count() >= cores


@cache
def _used(name: str) -> tuple[str, ...]:
    return tuple(t for t in BASE_TABLES if "{" + t + "}" in ADAPTERS[name])


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The adapter as Spark reads it, with its order columns as one ``_row_ord``."""
    tables = {t: base_table(spark, sf_dir, t) for t in _used(name)}
    query = re.sub(r'"([A-Z][A-Z0-9 _/()-]*)"(?=[,\s])', r"`\1`", ADAPTERS[name])
    rows = spark.sql(query, **tables)
    order = [c for c in rows.columns if _UPPER_EXPORTS.match(c)]
    if not order:
        return rows
    key = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return rows.withColumn(ROW_ORDER, key).drop(*order)
