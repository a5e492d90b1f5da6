from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import functions as F

from leaseload.sources.contracts import (
    CUSTOMER_KEYS, LEASE_KEYS, LINK_KEYS, UNIT_KEYS, ContractError, bind, check_constraints, check_target, find_column,
    optional, require, validation_report,
)
from leaseload.sources.exports import (
    drop_blank_key, drop_empty_rows, ends_open, normal_header, read_export, scanned, shared_folder, stage, trim_cells, with_header,
)
from leaseload.sources.runs import newest_runs, read_runs, record_run, run_statistics
from leaseload.sources.tables import read_jdbc_table, read_table


def test_header_is_normalised_and_repeats_are_numbered():
    assert normal_header([" a ", "dDeleted", "ddeleted", "A"]) == ["A", "DDELETED", "DDELETED.1", "A.1"]


def read(spark, path, **options):
    """Rows of an export in their order, without it."""
    rows = read_export(spark, str(path), **options)
    return [tuple(r)[:-1] for r in rows.orderBy("_row_ord").collect()]


@pytest.fixture
def small_splits(spark):
    """Splits of a few dozen bytes."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)

    def of(size):
        spark.conf.set(name, str(size))

    yield of
    spark.conf.set(name, before)


def test_read_export(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_bytes(
        'chargeid, memo ,Totals & Averages\r\n1.0,"two\nlines, ""quoted""",9\r\n,NA,9\r\n3,caf\xe9,9\r\n'.encode("latin-1")
    )
    rows = read_export(spark, str(path), encoding="ISO-8859-1")
    assert [c for c in rows.columns if c != "_row_ord"] == ["CHARGEID", "MEMO"]
    assert read(spark, path) == [("1.0", 'two\nlines, "quoted"'), (None, None), ("3", "café")]
    assert drop_empty_rows(rows).count() == 2
    assert drop_blank_key(rows, "CHARGEID").count() == 2
    assert read(spark, path, strict_na=False)[1][1] == "NA"


def test_each_file_has_its_own_encoding(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("\ufeffID,NAME\n1,Zo\u00eb \u4e2d\n".encode())
    (tmp_path / "b.csv").write_bytes("ID,NAME\n2,Zo\u00eb\n".encode("latin-1"))
    (tmp_path / "c.csv").write_bytes(b"ID,NAME\n3,plain\n")
    assert read(spark, tmp_path) == [("1", "Zo\u00eb \u4e2d"), ("2", "Zo\u00eb"), ("3", "plain")]


def test_files_of_a_folder_bind_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID,AMT\n1,10\n")
    (tmp_path / "b.csv").write_text("AMT,ID\n20,2\n")
    (tmp_path / "c.csv").write_text("\n \nID,MEMO\n3,x,extra\n\n4\n")
    (tmp_path / "d.csv").write_text("")
    assert read(spark, tmp_path) == [("1", "10", None), ("2", "20", None), ("3", None, "x"), ("4", None, None)]


def test_header_with_a_line_break(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ID,"ME\nMO"\n1,x\n')
    rows = read_export(spark, str(tmp_path))
    assert [c for c in rows.columns if c != "_row_ord"] == ["ID", "ME\nMO"]
    assert [r.ID for r in rows.collect()] == ["1"]


def test_inch_marks_and_odd_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ID,SIZE,NOTE\n1,5" door,x\n2,"5"" door",""\n3,a"b"c,d"\n4,"q"tail,"x, y"\n5,,"\n"\n')
    assert read(spark, tmp_path, strict_na=False) == [
        ("1", '5" door', "x"), ("2", '5" door', None), ("3", 'a"b"c', 'd"'), ("4", '"q"tail', "x, y"), ("5", None, "\n"),
    ]


def test_an_unclosed_cell_ends_the_job(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ID,MEMO\n1,"never\n2,closed\n')
    with pytest.raises(Exception, match="not closed in .*a.csv"):
        read_export(spark, str(tmp_path)).collect()


def test_an_export_without_a_line_has_no_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n\n")
    with pytest.raises(ValueError, match="no header"):
        read_export(spark, str(tmp_path))


@pytest.mark.parametrize("split", [40, 97, 1000])
def test_line_breaks_in_cells_over_splits(spark, tmp_path, small_splits, split):
    """Files with line breaks, quotes and commas in cells, read in many tasks, as the csv module reads them."""
    rng = random.Random(split)
    pieces = ["a", "\n", '"', ",", "b c", "\r\n", "", '5" x', "é"]
    written = []
    for n in range(2):
        rows = [[str(i), *["".join(rng.choice(pieces) for _ in range(rng.randrange(6))) for _ in range(2)]] for i in range(20)]
        with open(tmp_path / f"f{n}.csv", "w", newline="", encoding="utf-8") as out:
            csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"])).writerows([["ID", "A", "B"], *rows])
        written += [tuple(None if c == "" else c for c in row) for row in rows]
    small_splits(split)
    lines = scanned(spark, str(tmp_path))
    blocks = lines.select("path", "block").distinct().count()
    assert blocks > 5 or split == 1000
    assert read(spark, tmp_path, strict_na=False) == written


def test_state_of_a_line(spark):
    lines = ['a,b', '"a', 'a"', '"a"', '"a""', 'x,"', '","', 'a,"b",c', '5" x', '""', '"""', 'a"",b', '"a"b"', '"a"b,"c']
    frame = spark.createDataFrame([(x,) for x in lines], "x string")
    found = frame.select("x", ends_open(F.col("x"), False).alias("o"), ends_open(F.col("x"), True).alias("s")).collect()
    for r in found:
        for state, before in ((r.o, ""), (r.s, '"')):
            closed = list(csv.reader([before + r.x + "\n", "END\n"]))
            assert state == (len(closed) == 1), (r.x, before)


def test_one_job_plans_many_files(spark, tmp_path):
    """The plan holds no file name, however many files there are."""
    for n in range(60):
        (tmp_path / f"f{n:03}.csv").write_text(f"ID,N\n{n},x\n")
    rows = read_export(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().analyzed().toString()
    assert "f007.csv" not in plan
    assert [r.ID for r in rows.orderBy("_row_ord").collect()] == [str(n) for n in range(60)]


def test_row_order_follows_the_file_over_splits(spark, tmp_path, small_splits):
    path = tmp_path / "big.csv"
    path.write_text("id\n" + "\n".join(str(n) for n in range(20000)) + "\n")
    small_splits(16384)
    assert scanned(spark, str(path)).select("block").distinct().count() > 1
    staged = stage(read_export(spark, str(path)))
    assert [int(r.ID) for r in staged.orderBy("_row_ord").select("ID").collect()] == list(range(20000))


def test_stage_needs_the_shared_folder(spark):
    class Unset:
        class conf:
            @staticmethod
            def get(name, default):
                return default

    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Unset)
    for master in ("local-cluster[3,2,1024]", "spark://host:7077", "yarn"):
        Unset.conf.get = staticmethod(lambda name, default, m=master: m if name == "spark.master" else default)
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(Unset)
    Unset.conf.get = staticmethod(lambda name, default: "local[4]" if name == "spark.master" else default)
    assert shared_folder(Unset) == shared_folder(Unset)


def test_trim_and_header_of_a_frame(spark):
    frame = spark.createDataFrame([(" 1 ", "x", 0)], "` id ` string, `totals & averages` string, _row_ord int")
    cleaned = trim_cells(with_header(frame))
    assert cleaned.columns == ["ID", "_row_ord"]
    assert cleaned.first().ID == "1"


def test_exact_name_beats_prefix():
    columns = ["Unit Access Hours", "UNIT ACCESS", "SMIALT", "SMI"]
    assert find_column(columns, "UNIT ACCESS") == "UNIT ACCESS"
    assert find_column(columns, "smi") == "SMI"
    assert find_column(columns, "UNIT ACC") == "Unit Access Hours"
    assert find_column(columns, "ZZ") is None


def test_missing_columns_are_all_named(export):
    frame = export(["TENANTID", "SUNITNAME"], [("1", "U")])
    with pytest.raises(ContractError, match="DCRENT, DCSCHEDRENT"):
        bind(frame, LINK_KEYS)
    with pytest.raises(ContractError, match="LEDGERID"):
        require(frame, ("LEDGERID", "TENANTID"))


def test_contract_sizes():
    assert (len(UNIT_KEYS), len(CUSTOMER_KEYS), len(LINK_KEYS), len(LEASE_KEYS)) == (27, 28, 10, 11)


def test_optional_column(export):
    frame = export(["A"], [("1",)])
    row = frame.select(optional(frame, "A").alias("a"), optional(frame, "B").alias("b")).first()
    assert (row.a, row.b) == ("1", None)


def test_validation_report(export):
    frame = export(["UNITNAME X", "WIDTH", "OTHER"], [("1", "2", "3"), (None, None, None)])
    report = {(r.role, r.key): (r.column, r.rows_total, r.rows_empty) for r in validation_report(frame, ("UNITNAME",)).collect()}
    assert report == {
        ("required", "UNITNAME"): ("UNITNAME X", 2, 1), ("ignored", "WIDTH"): ("WIDTH", 2, 1), ("unused", "OTHER"): ("OTHER", 2, 1),
    }


def test_target_checks(spark):
    target = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "id int, external_id string")
    assert [r.external_id for r in check_target(target, ("id",), ("external_id",)).collect()] == ["a"]
    with pytest.raises(ContractError):
        check_target(target, ("missing",), ("id",))
    broken = check_constraints(target, {"small": F.col("id") < 3, "named": F.col("external_id").isNotNull()}, ("id",))
    assert sorted((r.id, r.constraint) for r in broken.collect()) == [(3, "named"), (3, "small"), (4, "named"), (4, "small")]


def test_table_scan_pushes_scope_and_columns(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 3 AS organization_id", "id AS other").write.parquet(str(tmp_path / "t"))
    table = read_table(spark, str(tmp_path / "t"), ("id",), F.col("organization_id") == 1)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(organization_id,1)" in plan and "other" not in plan
    assert table.count() == 33


def test_run_history(spark, tmp_path):
    path = tmp_path / "runs.json"
    path.write_text(
        '{"runs": [\n{"run_id": "a", "status": "success", "started_at": "2020-01-02", "files": ["f"]},\n'
        '{"run_id": "b", "status": "error", "started_at": "2020-01-03", "files": []}]}'
    )
    runs = read_runs(spark, str(path))
    stats = run_statistics(runs).first()
    assert (stats.total, stats.success, stats.errors, stats.last_run) == (2, 1, 1, "b")
    assert [r.run_id for r in newest_runs(runs, 1).collect()] == ["b"]
    changed = record_run(runs, runs.filter("run_id = 'b'").withColumn("status", F.lit("success")))
    assert sorted((r.run_id, r.status) for r in changed.collect()) == [("a", "success"), ("b", "success")]


def test_jdbc_read_must_be_split(spark):
    with pytest.raises(ValueError, match="upperBound, numPartitions"):
        read_jdbc_table(spark, "jdbc:none", "t", ("id",), partitionColumn="id", lowerBound="0")
