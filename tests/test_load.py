from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from leaseload.operators.keys import first_rows, last_wins, latest_rows, repeats, without_known
from leaseload.operators.load import (
    append, assign_ids, insert_new, new_rows, numbered, upsert, write_rejects, write_review, write_snapshot,
)
from leaseload.operators.reconcile import backfill_created_by, recalculate_invoices, status_distribution
from leaseload.params import Params
from leaseload.sources.exports import stage


def test_first_and_last_rows(spark):
    frame = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z"), (None, 4, "n"), (None, 5, "m")], "k string, o int, v string")
    assert sorted(r.v for r in first_rows(frame, ["k"], ["o"]).collect()) == ["y", "z"]
    assert sorted(r.v for r in first_rows(frame, ["k"], ["o"], keep_null_keys=True).collect()) == ["m", "n", "y", "z"]
    assert sorted((r.k, r.v) for r in last_wins(frame, ["k"], ["v"], F.col("o")).collect()) == [("a", "x"), ("b", "z")]
    assert sorted((r.k, r.o, r.v) for r in last_wins(frame, ["k"], ["o", "v"], F.col("o")).collect()) == [("a", 3, "x"), ("b", 2, "z")]
    assert [r.v for r in repeats(frame, ["k"], "o").collect()] == ["x"]


def test_last_wins_keeps_a_null_of_the_last_row(spark):
    frame = spark.createDataFrame([("a", 1, "x"), ("a", 2, None)], "k string, o int, v string")
    assert last_wins(frame, ["k"], ["v"], F.col("o")).first().v is None


def test_latest_rows_put_undated_rows_last(spark):
    frame = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("a", 9, 3), ("a", 9, 4)], "k string, d int, o int")
    assert latest_rows(frame, ["k"], F.col("d"), ["o"]).first().o == 3


def test_null_safe_anti_join(spark):
    facts = spark.createDataFrame([(1, None), (2, 5), (3, None)], "a int, b int")
    known = spark.createDataFrame([(1, None), (2, 6)], "a int, b int")
    on = [("a", "a"), ("b", "b")]
    assert sorted(r.a for r in without_known(facts, known, on, null_safe=True).collect()) == [2, 3]
    assert sorted(r.a for r in without_known(facts, known, on).collect()) == [1, 2, 3]


def test_insert_new_is_idempotent(spark):
    target = spark.createDataFrame([("1", "old")], "k string, v string")
    source = spark.createDataFrame([("1", "new", 0), ("2", "a", 2), ("2", "b", 1), (None, "n", 3), (None, "n", 4)], "k string, v string, _row_ord int")
    once = insert_new(target, source, ["k"])
    assert sorted((r.k or "", r.v) for r in once.collect()) == [("", "n"), ("", "n"), ("1", "old"), ("2", "b")]
    keyed = source.filter("k IS NOT NULL")
    assert insert_new(insert_new(target, keyed, ["k"]), keyed, ["k"]).count() == 2


def test_conditional_key(spark):
    target = spark.createDataFrame([(1, "ACTIVE"), (2, "ENDED")], "unit int, status string")
    rows = [(1, "ACTIVE", 0), (1, "ENDED", 1), (2, "ACTIVE", 2), (2, "ACTIVE", 3)]
    source = spark.createDataFrame(rows, "unit int, status string, _row_ord int")
    added = new_rows(target, source, ["unit"], key_filter=F.col("status") == "ACTIVE")
    assert sorted(r._row_ord for r in added.collect()) == [1, 2]


def test_no_row_with_a_null_key_gets_lost(spark):
    """Also where the order of such rows is equal or null."""
    target = spark.createDataFrame([("1", "old")], "k string, v string")
    rows = [(None, "x", 5), (None, "y", 5), (None, "x", 5), (None, "z", None), (None, "z", None), ("1", "n", 5), ("2", "a", 5), ("2", "b", None)]
    source = spark.createDataFrame(rows, "k string, v string, _row_ord int").repartition(3)
    added = new_rows(target, source, ["k"])
    assert sorted((r.k or "", r.v) for r in added.collect()) == [("", "x"), ("", "x"), ("", "y"), ("", "z"), ("", "z"), ("2", "b")]
    outside = new_rows(target, source, ["k"], key_filter=F.col("v") == "nothing")
    assert outside.count() == len(rows)


def test_upsert_touches_only_listed_columns(spark):
    target = spark.createDataFrame([(1, "a", "me"), (2, "b", "me")], "id int, v string, created string")
    source = spark.createDataFrame([(2, "B", "you"), (3, "C", "you")], "id int, v string, created string")
    merged = upsert(target, source, ["id"], ["v"])
    assert sorted(map(tuple, merged.collect())) == [(1, "a", "me"), (2, "B", "me"), (3, "C", "you")]


def test_upsert_can_set_null(spark):
    target = spark.createDataFrame([(1, "a")], "id int, v string")
    source = spark.createDataFrame([(1, None)], "id int, v string")
    assert upsert(target, source, ["id"], ["v"]).first().v is None


def test_assigned_ids_are_gapless_stable_and_above_the_target(spark):
    target = spark.createDataFrame([(41,), (7,)], "id bigint")
    source = spark.range(5000).select((F.col("id") * 3).cast("string").alias("k"))
    expected = {k: 42 + n for n, k in enumerate(sorted(str(3 * i) for i in range(5000)))}
    for rows in (source, source.repartition(7), source.withColumn("id", F.lit(None).cast("bigint"))):
        assert {r.k: r.id for r in assign_ids(rows, target, "k").collect()} == expected
    empty = assign_ids(source, target.filter("id < 0"), "k")
    assert sorted(r.id for r in empty.collect()) == list(range(1, 5001))
    assert assign_ids(source.filter("false"), target, "k").count() == 0


def test_numbering_spreads_over_tasks(spark):
    """Also where a third of all rows are equal in the order's first column."""
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("a"), "id")
    found = numbered(rows, ["a", "id"], "n")
    assert found.select("n").distinct().count() == 9000 and found.agg(F.max("n")).first()[0] == 9000
    assert found.groupBy(F.spark_partition_id()).count().count() >= 1
    tasks = {r["_part"]: r["count"] for r in stage(rows.repartitionByRange(4, "a", "id").withColumn("_part", F.spark_partition_id())).groupBy("_part").count().collect()}
    assert len(tasks) == 4 and max(tasks.values()) < 4500
    ordered = found.orderBy("n").collect()
    assert [(r.a, r.id) for r in ordered] == sorted((r.a, r.id) for r in ordered)


def test_sinks(spark, tmp_path):
    frame = spark.createDataFrame([("1", "skip", "why", "F", "v")], "row_id string, outcome string, reason string, field string, value string")
    write_snapshot(frame, str(tmp_path / "t"))
    with pytest.raises(Exception, match="(?i)exist"):
        write_snapshot(frame, str(tmp_path / "t"))
    append(frame, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    write_review(frame, str(tmp_path / "review"))
    assert spark.read.option("header", True).csv(str(tmp_path / "review")).first().reason == "why"
    for plan in ("a", "b"):
        write_rejects(frame, plan, Params().now, str(tmp_path / "rejects"))
    back = spark.read.parquet(str(tmp_path / "rejects"))
    assert {r.plan for r in back.collect()} == {"a", "b"} and "run_ts" in back.columns


def test_backfill_created_by(spark):
    users = spark.createDataFrame([(100, 1), (200, None), (300, None)], "id bigint, external_id bigint")
    table = spark.createDataFrame([(1, 1, 5), (2, 9, 5), (3, None, 5)], "id bigint, external_employee_id bigint, created_by bigint")
    assert {r.id: r.created_by for r in backfill_created_by(table, users).collect()} == {1: 100, 2: None, 3: 5}


def test_two_users_with_one_external_id_end_the_job(spark):
    users = spark.createDataFrame([(100, 1), (101, 1)], "id bigint, external_id bigint")
    table = spark.createDataFrame([(1, 1, 5)], "id bigint, external_employee_id bigint, created_by bigint")
    with pytest.raises(Exception, match="several users with external id 1"):
        backfill_created_by(table, users).collect()


def test_every_invoice_is_reviewed(spark):
    invoices = spark.sql("SELECT id, 100L AS total_in_cents, DATE '2020-01-01' AS due_date, 'x' AS status FROM range(4)")
    payments = spark.createDataFrame([(0, 100), (1, 40), (1, 10), (None, 5), (99, 1)], "invoice_id bigint, amount_in_cents bigint")
    from datetime import date

    done = recalculate_invoices(invoices, payments, Params(as_of=date(2020, 1, 1)))
    assert sorted((r.id, r.status, r.amount_paid_in_cents, r.balance_in_cents) for r in done.collect()) == [
        (0, "PAID", 100, 0), (1, "PARTIAL_PAID", 50, 50), (2, "OVERDUE", 0, 100), (3, "OVERDUE", 0, 100),
    ]
    assert {r.status: (r.n_invoices, r.share_bp) for r in status_distribution(done).collect()} == {
        "PAID": (1, 2500), "PARTIAL_PAID": (1, 2500), "OVERDUE": (2, 5000),
    }


def test_params_are_checked():
    with pytest.raises(ValueError, match="on_match"):
        Params(on_match="replace")
