"""Column functions over whole exports, next to their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract.registry import (
    PARAMS, PAYMENT_FORMATS, TODAY_SQL, Tables, big, cents, check, clean, day, free_at, idt, money_cents, num, paid_at,
    strptime, ts, vc,
)
from contract.tenancy_plans import _rate, next_billing_sql
from leaseload.functions import dates, enums, numbers, records, text


@check("clean_text", ("x_customers",), f"""
    SELECT _o1 AS c, _o2 AS n, {clean('SFNAME')} AS first_name, {clean('SADDR2')} AS address2,
           CASE WHEN {clean('SFNAME')} IS NOT NULL THEN {clean('SFNAME')} || COALESCE(' ' || {clean('SMI')}, '') END AS full_name,
           substr({clean('SEMAIL')}, 1, 10) AS access_code, COALESCE(lower(trim(SADDR2)) NOT IN ('', 'nan', 'nat', 'none'), FALSE) AS filled,
           NULLIF(concat_ws(', ', NULLIF(trim(SLNAME), ''), NULLIF(trim(SFNAMEALT), '')), '') AS last_first
    FROM x_customers""")
def clean_text(t: Tables) -> DataFrame:
    return t("x_customers").select(
        F.col("_row_ord._o1").alias("c"), F.col("_row_ord._o2").alias("n"),
        text.clean_text("SFNAME").alias("first_name"), text.clean_text("SADDR2").alias("address2"),
        text.full_name("SFNAME", "SMI").alias("full_name"), text.access_code("SEMAIL").alias("access_code"),
        text.has_value("SADDR2").alias("filled"), text.last_comma_first("SLNAME", "SFNAMEALT").alias("last_first"),
    )


# Ids of 19 digits, which a bigint holds, and of 20, which it does not.
LONG_ID_SQL = """(CASE WHEN _o1 % 2 = 0 THEN '12345678901' || lpad(CAST(_o1 AS VARCHAR), 8, '0')
    ELSE '987654321098' || lpad(CAST(_o1 AS VARCHAR), 8, '0') || '.0' END)"""


@check("ids_to_numbers", ("x_charges",), f"""
    SELECT _o1 AS line, _o2 AS supplier, {vc(big('CHARGEDESCID'))} AS desc_id, {idt('CHARGEDESCID')} AS desc_text, {idt('CHARGEID')} AS charge_text,
           {big('LEDGERID')} AS ledger_id, split_part(trim(LEDGERID), '.', 1) AS ledger_cut,
           {vc(big(LONG_ID_SQL))} AS long_id, {idt(LONG_ID_SQL)} AS long_text FROM x_charges""", as_text=("desc_id", "long_id"))
def ids_to_numbers(t: Tables) -> DataFrame:
    line = F.col("_row_ord._o1")
    zeros = F.lpad(line.cast("string"), 8, "0")
    long_id = F.when(line % 2 == 0, F.concat(F.lit("12345678901"), zeros)).otherwise(
        F.concat(F.lit("987654321098"), zeros, F.lit(".0"))
    )
    return t("x_charges").select(
        F.col("_row_ord._o1").alias("line"), F.col("_row_ord._o2").alias("supplier"),
        numbers.whole_number("CHARGEDESCID").alias("desc_id"), numbers.id_text("CHARGEDESCID").alias("desc_text"),
        numbers.id_text("CHARGEID").alias("charge_text"), numbers.whole_number("LEDGERID").alias("ledger_id"),
        numbers.id_before_point("LEDGERID").alias("ledger_cut"),
        numbers.whole_number(long_id).alias("long_id"), numbers.id_text(long_id).alias("long_text"),
    )


@check("money_to_cents", ("x_payments",), f"""
    SELECT _o1 AS line, _o2 AS supplier, {vc(money_cents('DCPMTAMT'))} AS cents,
           {vc(f"CASE WHEN {money_cents('DCPMTAMT')} < 0 THEN 0 ELSE {money_cents('DCPMTAMT')} END")} AS floored,
           {vc(cents('DCPMTAMT'))} AS signed, {vc(f"0 - abs({cents('DCPMTAMT')})")} AS negative, {vc(_rate('DCPMTAMT'))} AS dollars,
           CASE WHEN _o2 % 2 = 0 THEN NULL ELSE printf('%d.25', 1000000000 + _o1) END AS large FROM x_payments""",
    as_text=("cents", "floored", "signed", "negative"))
def money_to_cents(t: Tables) -> DataFrame:
    whole = F.when(F.col("_row_ord._o2") % 2 == 0, 10_000_000_000).otherwise(1_000_000_000) + F.col("_row_ord._o1")
    large = F.concat(whole.cast("string"), F.lit(".25"))
    return t("x_payments").select(
        F.col("_row_ord._o1").alias("line"), F.col("_row_ord._o2").alias("supplier"),
        numbers.cents("DCPMTAMT").alias("cents"), numbers.floored_cents("DCPMTAMT").alias("floored"),
        numbers.signed_cents("DCPMTAMT").alias("signed"), numbers.negative_cents("DCPMTAMT").alias("negative"),
        numbers.dollars("DCPMTAMT").alias("dollars"),
        # Beyond the type: null, never zero.
        numbers.dollars(large).cast("string").alias("large"),
    )


@check("money_with_marks", ("x_tenancy",), f"""
    SELECT _o1 AS tenancy, {vc(money_cents('DCRENT'))} AS rent, {money_cents('DCSECDEPPAID')} AS deposit, {money_cents('DCINSURPREMIUM')} AS premium,
           {vc(f"CASE WHEN {money_cents('DCSCHEDRENT')} = 0 THEN {money_cents('DCRENT')} ELSE {money_cents('DCSCHEDRENT')} END")} AS scheduled,
           CASE WHEN {money_cents('DCINSURPREMIUM')} > 0 THEN 'BASIC' ELSE 'NONE' END AS insurance FROM x_tenancy""",
    as_text=("rent", "scheduled"))
def money_with_marks(t: Tables) -> DataFrame:
    rent, premium = numbers.cents("DCRENT"), numbers.cents("DCINSURPREMIUM")
    return t("x_tenancy").select(
        F.col("_row_ord").alias("tenancy"), rent.alias("rent"), numbers.cents("DCSECDEPPAID").alias("deposit"),
        premium.alias("premium"), numbers.zero_takes(numbers.cents("DCSCHEDRENT"), rent).alias("scheduled"),
        enums.insurance_option(premium).alias("insurance"),
    )


@check("parse_payment_dates", ("x_payments",), f"""
    SELECT _o1 AS line, _o2 AS supplier, {ts(paid_at('DPMT'))} AS paid_at, {ts(paid_at('DCREATED'))} AS created_at, {ts(paid_at('DDELETED'))} AS deleted_at
    FROM x_payments""")
def parse_payment_dates(t: Tables) -> DataFrame:
    return t("x_payments").select(
        F.col("_row_ord._o1").alias("line"), F.col("_row_ord._o2").alias("supplier"),
        dates.payment_timestamp("DPMT").alias("paid_at"), dates.payment_timestamp("DCREATED").alias("created_at"),
        dates.payment_timestamp("DDELETED").alias("deleted_at"),
    )


@check("parse_spelled_dates", ("x_spelled",), f"""
    SELECT _o1 AS o, CASE _o1 % 12 WHEN 2 THEN {ts("day + to_hours(CAST((_o1 % 12 + 1) % 12 + 12 AS INTEGER)) + INTERVAL 4 MINUTE")}
        WHEN 3 THEN {ts("day + to_hours(CAST(_o1 % 10 AS INTEGER)) + INTERVAL 306 SECOND")}
        WHEN 4 THEN {ts("day + INTERVAL 39906 SECOND")} WHEN 8 THEN {ts("day + to_hours(CAST((_o1 % 12 + 1) % 12 AS INTEGER))")}
        WHEN 10 THEN NULL WHEN 11 THEN NULL ELSE {ts("CAST(day AS TIMESTAMP)")} END AS parsed FROM x_spelled""")
def parse_spelled_dates(t: Tables) -> DataFrame:
    """Month words, weekdays, day endings, AM and PM, zones, and texts that hold no date."""
    return t("x_spelled").select(F.col("_row_ord").alias("o"), dates.free_timestamp("SPELLED").alias("parsed"))


@check("parse_free_dates", ("x_charges",), f"""
    SELECT _o1 AS line, _o2 AS supplier, {ts(free_at('DCHGSTRT'))} AS started, {ts(free_at('DCREATED'))} AS created,
           {ts(free_at('DUPDATED'))} AS updated, {day(free_at('DDELETED'))} AS deleted,
           strftime(DATE '1995-01-01' + CAST(_o1 % 3000 AS INTEGER), '%Y-%m-%d') ||
               CASE _o1 % 6 WHEN 0 THEN ' 03:04:05' WHEN 1 THEN ' 23:14:15' ELSE ' 00:00:00' END AS machine
    FROM x_charges""")
def parse_free_dates(t: Tables) -> DataFrame:
    line = F.col("_row_ord._o1")
    on = F.date_add(F.lit("1995-01-01").cast("date"), (line % 3000).cast("int"))
    shapes = ("yyyy-MM-dd' 03:04:05.1234567'", "yyyy-MM-dd'T23:14:15Z'", "yyyy/MM/dd", "yyyyMMdd", "M/d/yy", "d-MMM-yyyy")
    machine = F.coalesce(*[F.when(line % 6 == n, F.date_format(on, shape)) for n, shape in enumerate(shapes)])
    return t("x_charges").select(
        F.col("_row_ord._o1").alias("line"), F.col("_row_ord._o2").alias("supplier"),
        dates.free_timestamp("DCHGSTRT").alias("started"), dates.free_timestamp("DCREATED").alias("created"),
        dates.free_timestamp("DUPDATED").alias("updated"), dates.free_date("DDELETED").alias("deleted"),
        dates.free_timestamp(machine).alias("machine"),
    )


@check("parse_dates_after_1900", ("x_credits",), f"""
    SELECT _o1 AS line, _o2 AS supplier, CASE WHEN {free_at('DCREDIT')} >= DATE '1900-01-02' THEN {ts(free_at('DCREDIT'))} END AS credited,
           CASE WHEN {free_at('DCREATED')} >= DATE '1900-01-02' THEN {ts(free_at('DCREATED'))} END AS created FROM x_credits""")
def parse_dates_after_1900(t: Tables) -> DataFrame:
    return t("x_credits").select(
        F.col("_row_ord._o1").alias("line"), F.col("_row_ord._o2").alias("supplier"),
        dates.after_epoch("DCREDIT").alias("credited"), dates.after_epoch("DCREATED").alias("created"),
    )


@check("parse_billing_and_iso_dates", ("x_tenancy",), f"""
    SELECT _o1 AS tenancy, {day(strptime('DLEASE', ['%m/%d/%Y', '%Y-%m-%d']))} AS lease, {day(strptime('DMOVEDIN', ['%m/%d/%Y']))} AS moved_in,
           {day(strptime('DMOVEDIN', ['%m/%d/%Y', '%Y-%m-%d']))} AS moved_in_text,
           strftime(DATE '1970-01-01' + CAST(_o1 % 20000 AS INTEGER), '%Y-%m-%d') AS short FROM x_tenancy""")
def parse_billing_and_iso_dates(t: Tables) -> DataFrame:
    # Two-digit years on both sides of the turn of the century.
    on = F.date_add(F.lit("1970-01-01").cast("date"), (F.col("_row_ord") % 20000).cast("int"))
    short = F.date_format(on, "M/d/yy")
    return t("x_tenancy").select(
        F.col("_row_ord").alias("tenancy"), dates.billing_date("DLEASE").alias("lease"),
        dates.billing_date("DMOVEDIN").alias("moved_in"), dates.iso_text("DMOVEDIN").alias("moved_in_text"),
        dates.billing_date(short).alias("short"),
    )


@check("next_billing_date", ("x_tenancy",), f"""
    WITH d AS (SELECT _o1, CAST({strptime('DMOVEDIN', PAYMENT_FORMATS)} AS DATE) AS moved_in FROM x_tenancy)
    SELECT _o1 AS tenancy, CAST(day(moved_in) AS INTEGER) AS plain_day, CAST(least(day(moved_in), 28) AS INTEGER) AS held_day,
           {day(next_billing_sql('day(moved_in)'))} AS next_date FROM d WHERE moved_in IS NOT NULL""")
def next_billing_date(t: Tables) -> DataFrame:
    moved_in = F.col("moved_in")
    return (
        t("x_tenancy").select(F.col("_row_ord").alias("tenancy"), dates.free_date("DMOVEDIN").alias("moved_in"))
        .filter("moved_in IS NOT NULL")
        .select(
            "tenancy", dates.charge_day(moved_in).alias("plain_day"), dates.charge_day(moved_in, 28).alias("held_day"),
            dates.next_billing_date(PARAMS.today, F.dayofmonth(moved_in)).alias("next_date"),
        )
    )


@check("payment_texts", ("x_payments",), f"""
    SELECT _o1 AS line, _o2 AS supplier, 'SL-' || {idt('PAYMENTID')} AS receipt_number,
           CASE WHEN COALESCE(lower(BNSF) = 'true', FALSE) OR DDELETED IS NOT NULL THEN 'FAILED' ELSE 'COMPLETED' END AS status,
           NULLIF(concat_ws('; ', CASE WHEN lower(BNSF) = 'true' THEN 'NSF - Returned check' END,
                  'Voided in SiteLink on ' || COALESCE({day(paid_at('DDELETED'))}, DDELETED)), '') AS failure_reason,
           concat_ws(' ', 'Imported from SiteLink.', 'LedgerID: ' || {idt('LEDGERID')} || '.', 'ReceiptID: ' || {idt('RECEIPTID')} || '.') AS notes,
           {vc(f"CAST({big('PMTTYPEID')} AS INTEGER)")} AS method FROM x_payments""", as_text=("method",))
def payment_texts(t: Tables) -> DataFrame:
    return t("x_payments").select(
        F.col("_row_ord._o1").alias("line"), F.col("_row_ord._o2").alias("supplier"),
        records.payment_receipt_number(numbers.id_text("PAYMENTID")).alias("receipt_number"),
        records.payment_status("BNSF", "DDELETED").alias("status"),
        records.failure_reason("BNSF", "DDELETED").alias("failure_reason"),
        records.payment_notes(numbers.id_text("LEDGERID"), numbers.id_text("RECEIPTID")).alias("notes"),
        enums.payment_method_id("PMTTYPEID")[0].alias("method"),
    )


@check("yes_no", ("x_units",), """
    SELECT _o1 AS unit, _o2 AS n, CASE WHEN COALESCE(trim(ADA), '') = '' THEN FALSE WHEN lower(ADA) IN ('yes', 'y') THEN TRUE ELSE FALSE END AS ada,
           CASE WHEN COALESCE(trim(ADA), '') = '' THEN NULL WHEN lower(ADA) IN ('yes', 'y') THEN TRUE ELSE FALSE END AS ada_open,
           lower("POWER (YES/NO)") = 'maybe' AS power_bad FROM x_units""")
def yes_no(t: Tables) -> DataFrame:
    return t("x_units").select(
        F.col("_row_ord._o1").alias("unit"), F.col("_row_ord._o2").alias("n"), enums.yes_no("ADA")[0].alias("ada"),
        enums.yes_no("ADA", nullable=True)[0].alias("ada_open"),
        enums.yes_no("`POWER (YES/NO)`")[1].isNotNull().alias("power_bad"),
    )


@check("enum_maps", ("x_units",), f"""
    SELECT _o1 AS unit, _o2 AS n, CASE lower(trim(TYPE)) WHEN 'apartment' THEN 4 WHEN 'rv parking' THEN 5 WHEN 'boat parking' THEN 5 ELSE 1 END AS type_id,
           CASE lower(trim(ENTRYLOCK)) WHEN 'pad lock' THEN 'PAD_LOCK' WHEN 'padlock' THEN 'PAD_LOCK' WHEN 'smart lock' THEN 'SMART_LOCK'
                WHEN 'rfid' THEN 'RFID' WHEN 'bluetooth' THEN 'BLUETOOTH' END AS entry_lock,
           ENTRYLOCK = 'chain' AS lock_bad, replace(replace(lower(trim(UNITSIZE)), '*', 'x'), ' ', '') AS size_name,
           CASE WHEN lower(POWER_TIMER_HR) = 'continuous' THEN 'CONTINUOUS' WHEN lower(POWER_TIMER_HR) = 'no' THEN 'NO'
                WHEN {num('POWER_TIMER_HR')} >= 1 AND {num('POWER_TIMER_HR')} < 25 THEN 'HOURS_' || {vc(big('POWER_TIMER_HR'))} END AS timer
    FROM x_units""")
def enum_maps(t: Tables) -> DataFrame:
    lock, lock_error = enums.entry_lock("ENTRYLOCK")
    return t("x_units").select(
        F.col("_row_ord._o1").alias("unit"), F.col("_row_ord._o2").alias("n"), enums.unit_type_id("TYPE").alias("type_id"),
        lock.alias("entry_lock"), lock_error.isNotNull().alias("lock_bad"), enums.size_name("UNITSIZE").alias("size_name"),
        enums.power_timer("POWER_TIMER_HR")[0].alias("timer"),
    )


@check("charge_and_invoice_types", ("t_charges",), """
    SELECT id, CASE charge_type_id WHEN 3 THEN 1 WHEN 1 THEN 2 WHEN 21 THEN 3 WHEN 13 THEN 4 ELSE 7 END AS invoice_type_id,
           CASE charge_type_id WHEN 3 THEN 'RENTAL' WHEN 1 THEN 'DEPOSIT' WHEN 21 THEN 'INSURANCE' WHEN 13 THEN 'LATE_FEE' ELSE 'MISC' END AS invoice_type
    FROM t_charges""")
def charge_and_invoice_types(t: Tables) -> DataFrame:
    kind = enums.invoice_type_id("charge_type_id")
    return t("t_charges").select(
        "id", kind.alias("invoice_type_id"), enums.invoice_type_name(kind).alias("invoice_type")
    )


@check("billing_frequency_and_memo", ("x_tenancy",), f"""
    SELECT _o1 AS tenancy, CASE {idt('BILLINGFREQID')} WHEN '3' THEN 'MONTHLY' WHEN '4' THEN 'QUARTERLY' WHEN '5' THEN 'SEMI_ANNUALLY'
           WHEN '6' THEN 'ANNUAL' END AS frequency, {idt('BILLINGFREQID')} IN ('3', '4', '6') AS supported FROM x_tenancy""")
def billing_frequency_and_memo(t: Tables) -> DataFrame:
    frequency = enums.billing_frequency("BILLINGFREQID")
    return t("x_tenancy").select(
        F.col("_row_ord").alias("tenancy"), frequency.alias("frequency"),
        F.coalesce(enums.supported_frequency(frequency), F.lit(False)).alias("supported"),
    )


@check("credit_memo_types", ("x_credits",), f"""
    SELECT _o1 AS line, _o2 AS supplier, {vc("CASE lower(trim(SMEMO)) WHEN 'waived current late fee 1.' THEN 10000 WHEN 'waived current late fee 2.' THEN 10001 WHEN 'reservation fee' THEN 10002 END")}
           AS charge_type_id FROM x_credits""", as_text=("charge_type_id",))
def credit_memo_types(t: Tables) -> DataFrame:
    return t("x_credits").select(
        F.col("_row_ord._o1").alias("line"), F.col("_row_ord._o2").alias("supplier"),
        enums.credit_charge_type("SMEMO").alias("charge_type_id"),
    )


@check("card_fields", ("x_cards",), f"""
    SELECT _o1 AS card, CASE lower(trim(CardType)) WHEN 'master card' THEN 'mastercard' WHEN 'american express' THEN 'amex' WHEN '' THEN NULL
                             ELSE lower(trim(CardType)) END AS brand,
           right(replace(replace(CardNumber, '*', ''), ' ', ''), 4) AS last4, {vc(f"month({free_at('ExpirationDate')})")} AS exp_month,
           {vc(f"year({free_at('ExpirationDate')})")} AS exp_year,
           CASE WHEN contains(Name, ',') THEN trim(split_part(Name, ',', 1)) END AS surname FROM x_cards""", as_text=("exp_month", "exp_year"))
def card_fields(t: Tables) -> DataFrame:
    month, year = records.card_expiry("ExpirationDate")
    return t("x_cards").select(
        F.col("_row_ord").alias("card"), enums.card_brand("CardType").alias("brand"),
        records.card_last4("CardNumber").alias("last4"), month.alias("exp_month"), year.alias("exp_year"),
        records.surname("Name").alias("surname"),
    )
