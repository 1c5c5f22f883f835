"""All queries of the core library."""

from __future__ import annotations

from voxloom.plans.extras import EXTRAS
from voxloom.plans.intervals import INTERVALS, p2_found
from voxloom.plans.metrics import METRICS
from voxloom.plans.records import RECORDS
from voxloom.plans.registry import Query
from voxloom.plans.segments import SEGMENTS
from voxloom.plans.series import SERIES
from voxloom.plans.signals import SIGNALS
from voxloom.plans.streams import STREAMS
from voxloom.plans.vectors import VECTORS

REGISTRIES = (INTERVALS, RECORDS, METRICS, SERIES, SEGMENTS, VECTORS, STREAMS, SIGNALS, EXTRAS)
FLAGSHIP = p2_found


def queries() -> dict[str, Query]:
    return {name: q for r in REGISTRIES for name, q in r.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: s for r in REGISTRIES for name, s in r.sql.items()}
