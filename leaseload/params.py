"""Run parameters shared by every plan.

Nothing in this package reads a clock or an environment variable inside a
column expression: the caller fixes one ``run_ts`` and one ``as_of`` per run, so
that a retried task or a second run over the same input gives the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class Params:
    organization_id: int = 1
    location_id: int = 4
    created_by: int = 9
    external_source: str | None = None
    run_ts: datetime = field(default_factory=_utc_now)
    as_of: date | None = None
    on_match: str = "skip"

    def __post_init__(self) -> None:
        if self.on_match not in ("skip", "update"):
            raise ValueError(f"on_match must be 'skip' or 'update', got {self.on_match!r}")

    @property
    def now(self) -> Column:
        return F.lit(self.run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")

    @property
    def today(self) -> Column:
        return F.lit((self.as_of or self.run_ts.date()).isoformat()).cast("date")

    @property
    def organization(self) -> Column:
        return F.lit(self.organization_id).cast("bigint")

    @property
    def location(self) -> Column:
        return F.lit(self.location_id).cast("bigint")

    @property
    def author(self) -> Column:
        return F.lit(self.created_by).cast("bigint")

    def audit(self) -> dict[str, Column]:
        """The four bookkeeping columns most target tables carry."""
        return {
            "created_by": self.author,
            "updated_by": self.author,
            "created_datetime": self.now,
            "updated_datetime": self.now,
        }
