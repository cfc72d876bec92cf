"""Event time parsing and trailing-range predicates."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

SPANS = {"1h": dt.timedelta(hours=1), "6h": dt.timedelta(hours=6),
         "24h": dt.timedelta(hours=24), "5m": dt.timedelta(minutes=5)}


def _as_datetime(t) -> dt.datetime:
    if isinstance(t, dt.datetime):
        return t
    return dt.datetime.fromisoformat(str(t))


def ts_literal(t) -> Column:
    """A TIMESTAMP literal (session zone is UTC, see ``session.configure``)."""
    return F.lit(_as_datetime(t).isoformat(sep=" ")).cast("timestamp")


@dataclass(frozen=True)
class TimeRange:
    """Half-open event-time range ``[start, end)``; either side may be open."""
    start: dt.datetime | None = None
    end: dt.datetime | None = None

    def widen(self, before: dt.timedelta = dt.timedelta(0),
              after: dt.timedelta = dt.timedelta(0)) -> "TimeRange":
        return TimeRange(self.start - before if self.start else None,
                         self.end + after if self.end else None)

    def predicate(self, c: Column, literal=ts_literal) -> Column:
        cond = F.lit(True)
        if self.start is not None:
            cond = cond & (c >= literal(self.start))
        if self.end is not None:
            cond = cond & (c < literal(self.end))
        return cond


def trailing(as_of, span: dt.timedelta | str, until=None) -> TimeRange:
    """``[as_of - span, until)``: ``>= NOW() - INTERVAL`` with an explicit
    optional upper bound (historical data runs past ``as_of``).

    ``as_of=None`` means now, as local wall-clock time: event times are
    zoneless local times, read as-is in the UTC session.
    """
    if isinstance(span, str):
        span = SPANS[span]
    as_of = _as_datetime(as_of) if as_of is not None else dt.datetime.now().replace(microsecond=0)
    return TimeRange(as_of - span, _as_datetime(until) if until is not None else None)


def in_range(c: Column | str, rng: TimeRange | None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.lit(True) if rng is None else rng.predicate(c)


def parse_event_time(c: Column | str) -> Column:
    """ISO-8601 text -> TIMESTAMP, NULL when malformed (never raises)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(c)
