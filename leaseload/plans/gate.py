"""Gate activity export -> gate_access_log table (append only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaseload.functions.dates import free_timestamp
from leaseload.functions.records import gate_error, granted
from leaseload.functions.text import cut, last_comma_first, trimmed_or_null
from leaseload.operators.outcome import Outcome, Rule
from leaseload.params import Params
from leaseload.plans.common import classified, nothing
from leaseload.sources.contracts import GATE_COLUMNS, optional, require

GATE_TABLE = (
    "facility_id", "triggered_by", "pdk_device_id", "command", "pdk_response_status", "success",
    "error_message", "created_at",
)
COMMAND_LENGTH, PERSON_LENGTH = 32, 100


def load_gate_log(events: DataFrame, params: Params) -> Outcome:
    """Gate events with a readable time. No key, no join, no shuffle."""
    require(events, GATE_COLUMNS)
    rows = events.withColumn("_at", free_timestamp("OCCURRED"))
    at = F.col("_at")
    derived = {
        "facility_id": params.location,
        "triggered_by": cut(
            last_comma_first(optional(rows, "ACCESSORLASTNAME"), optional(rows, "ACCESSORFIRSTNAME")),
            PERSON_LENGTH,
        ),
        "pdk_device_id": nothing("bigint"),
        "command": cut(trimmed_or_null("ACCESSPOINTNAME"), COMMAND_LENGTH),
        "pdk_response_status": trimmed_or_null("DESCRIPTION"),
        "success": granted("DESCRIPTION"),
        "error_message": gate_error("DESCRIPTION"),
        "created_at": at,
    }
    before = [Rule("no_time", at.isNull(), "OCCURRED", F.col("OCCURRED"))]
    return Outcome(rows=classified(rows, F.col("OCCURRED"), derived, before), columns=GATE_TABLE)
