"""Fixed parameters of the contract queries.

The test data is historical, so "now" is an explicit ``as_of`` inside the
data, and every trailing range also gets ``until = as_of`` as upper bound
(the data runs past it). Oracle SQL uses the same literals.
"""

import datetime as dt

EVENTS_AS_OF = dt.datetime(2024, 1, 15, 12, 0, 0)
STAR_AS_OF = dt.datetime(1998, 6, 30, 4, 0, 0)

# Keyed-merge scenario: the stored table holds windows from events before
# MERGE_EXISTING_END, the incoming batch holds windows from events at or after
# MERGE_BATCH_START; their overlap includes one partially counted window.
MERGE_EXISTING_END = dt.datetime(2024, 1, 15, 12, 0, 30)
MERGE_BATCH_START = dt.datetime(2024, 1, 15, 0, 0, 0)

RANGE_FILTER_SPAN = "6h"
RANGE_FILTER_STORE = "purchase"
VELOCITY_MINUTES = 20


def sql_ts(t: dt.datetime) -> str:
    return f"TIMESTAMP '{t.isoformat(sep=' ')}'"

# Events of this span are partly kept from a stream whose windows a re-load of the
# whole day then puts right.
LOST_START, LOST_END = dt.datetime(2024, 1, 15, 1), dt.datetime(2024, 1, 15, 23)
BACKFILL_START, BACKFILL_END = dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 16)

# A trailing hour after the end of the events (the "no data" dashboard state).
EMPTY_AS_OF = dt.datetime(2024, 3, 1, 0, 0, 0)

# The incremental stream query stages the events in time slices at these
# bounds and restarts the stream from its checkpoint after each slice.
STREAM_SLICE_BOUNDS = (dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 16), dt.datetime(2024, 1, 24))

# The slice between these bounds reaches the streams last, long after the watermark has passed it.
LATE_START, LATE_END = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 12)

# A range that starts and ends off every coarse pre-aggregate's bounds.
ROLLUP_START, ROLLUP_END = dt.datetime(2024, 1, 3, 5, 17), dt.datetime(2024, 1, 27, 21, 43)

# Polls of the trailing hour over one day.
POLL_START, POLL_END, POLL_SECONDS = dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 16), 5

SESSION_GAP_MINUTES = 30
# A day, and the whole range, over which the per-second figures are not 0.
WHOLE_RANGE_START, WHOLE_RANGE_END = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
