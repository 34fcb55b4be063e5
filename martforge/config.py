"""Run parameters.

Every value that the original job hard-coded (calendar range, load stamp,
top-k sizes, optional aggregation years) is a field here so that tests and
production runs pick them explicitly.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date


@dataclass(frozen=True)
class PipelineConfig:
    # Inclusive daily calendar behind dim_tempo. None derives the bound from
    # the invoices: 1 January of the first sales year / 31 December of the last.
    calendar_start: date | None = date(2015, 1, 1)
    calendar_end: date | None = date(2026, 12, 31)
    # Load stamp written to data_atualizacao; None means current_date().
    run_date: date | None = None
    # Logical run date (YYYY-MM-DD); its calendar month is the lake partition.
    ds: str | None = None
    # Optional year filter for the marts (None = every year).
    aggregation_years: tuple[int, ...] | None = None
    # Report sizes.
    top_states: int = 10
    top_cities: int = 20
    # Buckets used by the dense surrogate-key operator; None = shuffle partitions.
    key_buckets: int | None = None
    # A percentage that does not fit its column (pct_desconto, pct_atingimento):
    # NULL and counted in the run's metrics (default), or raise.
    strict_pct: bool = False

    def with_(self, **kw) -> "PipelineConfig":
        return replace(self, **kw)


# Parameters for the driver fixtures: the calendar spans the years of the
# invoices (the default 2015-2026 range would leave every fixture sale without
# a calendar key).
FIXTURE_CONFIG = PipelineConfig(
    calendar_start=None,
    calendar_end=None,
    run_date=date(2001, 8, 31),
    ds="1998-06-15",
)
