from __future__ import annotations

import pytest

from leaseload.params import Params
from leaseload.streaming.gate import append_gate_events, gate_stream

COLUMNS = ("Occurred", "Description", "AccessPointName", "AccessorFirstName", "AccessorLastName")


def test_each_gate_file_is_loaded_once(spark, tmp_path):
    inbox, target, checkpoint = (tmp_path / n for n in ("inbox", "target", "checkpoint"))
    inbox.mkdir()
    header = ",".join(COLUMNS)
    (inbox / "a.csv").write_text(f"{header}\n1/2/2020 3:04:05 PM,Granted,Gate 1,Ann,Doe\nlater,x,y,,\n")

    def run():
        append_gate_events(gate_stream(spark, str(inbox), COLUMNS), Params(), str(target), str(checkpoint)).awaitTermination(120)
        return spark.read.parquet(str(target)).count()

    assert run() == 1
    assert run() == 1
    (inbox / "b.csv").write_text(f"{header}\n1/3/2020,Denied,Gate 2,,\n")
    assert run() == 2
    rows = {r.command: (r.success, r.error_message) for r in spark.read.parquet(str(target)).collect()}
    assert rows == {"Gate 1": (True, None), "Gate 2": (False, "Denied")}


def test_stream_reads_cells_as_the_batch_does(spark, tmp_path):
    inbox, target, checkpoint = (tmp_path / n for n in ("inbox", "target", "checkpoint"))
    inbox.mkdir()
    (inbox / "a.csv").write_text(f'{",".join(COLUMNS)}\n1/2/2020,"say ""hi"", ok",Gate,,\n')

    def run():
        events = gate_stream(spark, str(inbox), COLUMNS)
        append_gate_events(events, Params(), str(target), str(checkpoint)).awaitTermination(120)

    run()
    row = spark.read.parquet(str(target)).collect()[0]
    assert (row.command, row.error_message) == ("Gate", 'say "hi", ok')
    (inbox / "b.csv").write_text("Description,Occurred,AccessPointName,AccessorFirstName,AccessorLastName\nx,1/3/2020,G,,\n")
    with pytest.raises(Exception):
        run()
