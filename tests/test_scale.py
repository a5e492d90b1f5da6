"""Plan shapes that have to hold at any size: no hot group in one task, no pair
explosion, no Python in the rows, filters and columns pushed into the scan."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from contract.queries import CHECKS
from leaseload.operators.keys import attach, first_rows, hot_keys, last_wins
from leaseload.params import Params
from leaseload.session import tune

SMALL = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_no_plan_has_a_cross_join_or_python_rows(spark, name):
    plan = physical(CHECKS[name].run(spark, SMALL))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in plan


def hot(spark, n: int = 30000):
    """A third of all rows under one key, the others spread."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("o"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )


def test_first_wins_cuts_a_hot_key_before_the_shuffle(spark):
    winners = first_rows(hot(spark).repartition(6), ["k"], ["o"])
    plan = physical(winners)
    partial = plan.index("row_number(), 1, Partial")
    assert plan.index("row_number(), 1, Final") < partial
    assert "Exchange hashpartitioning(k" in plan[:partial]
    assert winners.count() == 20001


def test_last_wins_combines_before_the_shuffle(spark):
    plan = physical(last_wins(hot(spark), ["k"], ["payload"], F.col("o")))
    assert "partial_max_by" in plan


def test_hot_key_of_a_large_lookup_is_split(spark):
    """With both sides too large to broadcast, adaptive execution splits the hot key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        dim = spark.range(30000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("value"))
        joined = attach(hot(spark).repartition(8), dim, [("k", "key")])
        assert sum(r.value == 2 * r.k for r in joined.collect()) == 30000
        assert "SortMergeJoin(skew=true)" in physical(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_and_null_keys_are_spread_by_the_plan(spark):
    """Without adaptive execution no task gets the rows of a hot key, or those without a key."""
    settings = {
        "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).alias("k"),
            F.col("id").alias("_row_ord"),
        )
        dim = spark.range(30000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("value"))
        hot = hot_keys(rows, ["k"])
        assert [(r.k, r._lanes) for r in hot.collect()] == [(0, 500)]
        joined = attach(rows, dim, [("k", "key")], hot=hot)
        assert joined.columns == ["k", "_row_ord", "value"]
        tasks = joined.groupBy(F.spark_partition_id().alias("t")).count().collect()
        assert len(tasks) == 16 and max(r["count"] for r in tasks) < 1.5 * 30000 / 16
        found = {r._row_ord: r.value for r in joined.collect()}
        assert len(found) == 30000
        assert all(found[n] == (0 if n % 3 == 0 else None if n % 3 == 1 else 2 * n) for n in range(30000))
        # Null keys alone need no list of hot ones.
        bare = attach(rows.filter("k IS NULL OR k > 0"), dim, [("k", "key")])
        assert max(r["count"] for r in bare.groupBy(F.spark_partition_id().alias("t")).count().collect()) < 1.5 * 20000 / 16
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_small_lookups_are_broadcast_by_their_size(spark):
    dim = spark.range(100).select(F.col("id").alias("key"), F.lit("x").alias("value"))
    assert "BroadcastHashJoin" in physical(attach(hot(spark), dim, [("k", "key")]))


def test_library_gives_no_broadcast_hint_and_collects_nothing():
    from pathlib import Path

    root = Path(__file__).resolve().parents[1] / "leaseload"
    for source in root.rglob("*.py"):
        if "llm" in source.parts:
            continue  # text operators may run Python in their tasks and have tests of their own
        code = source.read_text()
        for word in ("F.broadcast(", ".collect()", ".toPandas(", "crossJoin", "localCheckpoint", "collect_list", "collect_set", ".rdd", "udf("):
            assert word not in code, f"{word} in {source.name}"


def test_scope_and_columns_reach_the_scan(spark):
    plan = physical(CHECKS["invoice_status_recalc"].run(spark, SMALL))
    schemas = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert schemas and all("l_partkey" not in s or "l_shipdate" in s for s in schemas)
    assert "l_returnflag" in plan and "l_discount" not in plan
    pushed = physical(CHECKS["payments_not_credits"].run(spark, SMALL))
    assert "ReadSchema" in pushed


def test_gate_log_needs_no_shuffle_of_its_own(spark):
    from leaseload.plans.gate import load_gate_log

    events = spark.createDataFrame([("1/1/2020", "x", "y", 0)], "OCCURRED string, DESCRIPTION string, ACCESSPOINTNAME string, _row_ord int")
    assert "Exchange" not in physical(load_gate_log(events, Params()).accepted)


def test_tune_sets_runtime_settings(spark):
    tune(spark)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_rejects_read_their_rows_twice(spark):
    def scans(name):
        return physical(CHECKS[name].run(spark, SMALL)).count("FileScan")

    assert scans("payments_rejects") <= 2 * scans("payments_load")


def test_insert_of_new_rows_reads_its_source_once(spark):
    from leaseload.operators.load import new_rows

    source = spark.read.parquet(f"{SMALL}/orders.parquet").select("o_custkey", "o_orderkey", "o_orderstatus")
    target = spark.range(5).select(F.col("id").alias("o_custkey"), F.lit("O").alias("o_orderstatus"))
    for held in (None, F.col("o_orderstatus") == "O"):
        plan = physical(new_rows(target, source, ["o_custkey"], order="o_orderkey", key_filter=held))
        assert plan.count("FileScan") == 1


def test_facts_with_few_codes_are_dealt_over_lanes(spark):
    """Seven codes, one of which holds most rows: no partition of the lookup holds them all."""
    from leaseload.operators.keys import attach_code

    facts = spark.range(20_000).select(F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("code"), F.col("id").alias("_row_ord"))
    facts = facts.withColumn("code", F.when(F.col("code") > 2, F.lit(3)).otherwise(F.col("code")))
    codes = spark.range(1, 7).select(F.col("id").alias("of"), (F.col("id") * 10).alias("kind"))
    set_before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        found = attach_code(facts, codes, [("code", "of")])
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) > 1 and max(sizes) < 3 * 20_000 / len(sizes)
        assert found.filter("kind <=> code * 10").count() == 20_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", set_before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_small_vocabulary_goes_to_the_facts(spark):
    """Also one that is derived from a table as large as the facts."""
    from leaseload.operators.keys import attach_code

    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    codes = lines.groupBy("l_linenumber").agg(F.max("l_linenumber").alias("kind"))
    assert "SortMergeJoin" not in physical(attach_code(lines, codes, [("l_linenumber", "l_linenumber")]))


def test_rejects_judge_their_rows_once(spark):
    """The plan that tells the rejects reads what was stored of the judged rows, not the exports."""
    plan = physical(CHECKS["charges_rejects"].run(spark, SMALL))
    assert plan.count("lineitem") <= 1


def test_a_table_whose_splits_feed_all_cores_is_not_shuffled(spark, tmp_path):
    from contract.adapters import base_table

    rows = spark.read.parquet(f"{SMALL}/orders.parquet")
    cores = spark.sparkContext.defaultParallelism
    rows.repartition(2 * cores).write.parquet(str(tmp_path / "orders.parquet"))
    rows.coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    split = {"spark.sql.files.maxPartitionBytes": "1k", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in split}
    try:
        for k, v in split.items():
            spark.conf.set(k, v)
        assert "Exchange" not in physical(base_table(spark, str(tmp_path), "orders"))
        # Many splits, but one row group: one core would read it.
        assert cores == 1 or "Exchange" in physical(base_table(spark, str(tmp_path), "lineitem"))
        assert base_table(spark, str(tmp_path), "orders").count() == rows.count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name, key", [
    ("charges_rejects", "external_charge_id"), ("charges_audit", "external_charge_id"), ("payments_rejects", "external_id"),
    ("payments_audit", "external_id"), ("receipts_rejects", "receipt_number"), ("credits_audit", "external_charge_id"),
])
def test_rejects_are_shuffled_by_their_key_once(spark, name, key):
    plan = physical(CHECKS[name].run(spark, SMALL))
    stored = name.startswith("payments")  # the stored ids are made distinct on their own
    assert len(re.findall(rf"Exchange hashpartitioning\((?:_k_)?{key}#", plan)) == 1 + stored


def fact_side(plan: str, key: str) -> str:
    """The columns of the facts that a lookup by ``key`` shuffles."""
    return re.search(rf"Exchange hashpartitioning\({key}#.*?Project \[(.*?) AS _lane#", plan, re.DOTALL).group(1)


@pytest.mark.parametrize("plan, key, cells", [
    ("charges", "_ledger", ("DDELETED", "DCAMT", "CHARGEDESCID")), ("payments", "_ledger", ("DDELETED", "DCPMTAMT", "PMTTYPEID", "DPMT", "DCREATED")),
    ("receipts", "_payment_key", ("DCAMT", "DRCPT")),
])
def test_rows_are_judged_before_a_lookup_shuffles_them(spark, export, plan, key, cells):
    """A lookup carries codes; the cells they were read from stay behind."""
    from leaseload.plans import charges, payments, receipts
    from leaseload.sources.contracts import CHARGE_COLUMNS, PAYMENT_COLUMNS, RECEIPT_COLUMNS

    tenants = export(["LEDGERID", "TENANTID", "SUNITNAME"], [("1", "1", "U1")])
    customers = spark.createDataFrame([(11, "1")], "id bigint, external_id string")
    units = spark.createDataFrame([(5, "U1")], "id bigint, unit_number string")
    kept = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in kept}
    for k, v in kept.items():
        spark.conf.set(k, v)
    try:
        if plan == "charges":
            rows = export([*CHARGE_COLUMNS, "DDELETED"], [(None,) * (len(CHARGE_COLUMNS) + 1)])
            stored = spark.createDataFrame([], "external_charge_id string")
            outcome = charges.load_charges(rows, export(["CHARGEDESCID", "ID"], [("1", "2")]), tenants, customers, units, stored, Params())
        elif plan == "payments":
            stored = spark.createDataFrame([], "external_id string")
            outcome = payments.load_payments(export(PAYMENT_COLUMNS, [(None,) * len(PAYMENT_COLUMNS)]), tenants, customers, stored, Params())
        else:
            paid = spark.createDataFrame([], "id bigint, external_payment_id string, payment_method_type_id bigint, payment_date date")
            methods = spark.createDataFrame([(1, "Cash")], "id bigint, name string")
            stored = spark.createDataFrame([], "receipt_number string")
            outcome = receipts.load_receipts(export(RECEIPT_COLUMNS, [(None,) * len(RECEIPT_COLUMNS)]), paid, methods, customers, stored, Params())
        carried = fact_side(physical(outcome.rows.select("_row_id", "_before", "_after")), key).split(", ")
        assert not [c for c in carried if re.match(rf"({'|'.join(cells)})#\d+$", c)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_payment_lookup_shuffles_no_more_than_is_asked_for(spark):
    from leaseload.plans.receipts import payment_lookup

    paid = spark.createDataFrame([(1, "7", 3, None)], "id bigint, external_payment_id string, payment_method_type_id bigint, payment_date date")
    lookup = payment_lookup(paid, spark.createDataFrame([(3, "Cash")], "id bigint, name string"))
    assert [tuple(r) for r in lookup.collect()] == [("7", 1, None, "Cash")]
    assert "max_by" not in physical(lookup.select("external_payment_id", "payment_id"))


def plain_rejects(rows, known):
    """Outcome by outcome in plain Python: (row id, reason, value)."""
    first = {}
    for key, before, after, _, order in rows:
        if key is not None and before is None and after is None:
            first[key] = min(order, first.get(key, order))
    for key, before, after, row_id, order in rows:
        if before is not None:
            yield row_id, before, "b"
        elif key is not None and (reasons := [reason for reason, keys in known.items() if key in keys]):
            yield row_id, reasons[0], None
        elif after is not None:
            yield row_id, after, "a"
        elif key is not None and order != first[key]:
            yield row_id, "repeat_in_file", None


@pytest.mark.parametrize("few", [0, 10**9])
def test_rejects_of_hot_keys(spark, monkeypatch, few):
    """A third of the rows under one key, another known, some rows without a key or stopped before."""
    from leaseload.operators import keys
    from leaseload.operators.outcome import Known, Outcome

    monkeypatch.setattr(keys, "HOT_ROWS", few)
    rows = [
        (
            None if n % 11 == 0 else "hot" if n % 3 == 0 else "known" if n % 5 == 0 else f"k{n // 2}",
            "deleted" if n % 7 == 0 else None, "no_date" if n % 13 == 0 else None, f"r{n}", 5000 - n,
        )
        for n in range(5000)
    ]
    frame = spark.createDataFrame(rows, "k string, b string, a string, _row_id string, _row_ord bigint").repartition(5).selectExpr(
        "k", "'skip|' || b || '|B' AS _before", "'skip|' || a || '|A' AS _after", "IF(b IS NULL, NULL, 'b') AS _before_value",
        "IF(a IS NULL, NULL, 'a') AS _after_value", "_row_id", "_row_ord",
    )
    table = spark.createDataFrame([("known",), ("k1",), ("k1",), (None,)], "id string")
    credited = spark.createDataFrame([("k2",), ("known",)], "id string")
    outcome = Outcome(frame, ("k",), ("k",), (Known(credited, (("k", "id"),), "credit"), Known(table, (("k", "id"),))))
    assert len(keys.hot_hashes(frame, ["k"])) == (0 if few else 2)
    expected = sorted(plain_rejects(rows, {"credit": {"k2", "known"}, "duplicate": {"known", "k1"}}), key=str)
    got = [(r.row_id, r.reason, r.value) for r in outcome.rejects.collect()]
    assert sorted(got, key=str) == expected
    settled = outcome.settled()
    assert sorted(((r.row_id, r.reason, r.value) for r in settled.rejects.collect()), key=str) == expected
