"""Column-level helpers (built-in Spark expressions only, no UDFs)."""

from tillstream.functions.money import (  # noqa: F401
    MONEY, money, money_sum, exact_mean, mean_of_means, round_half_up_ratio,
)
from tillstream.functions.timebounds import (  # noqa: F401
    TimeRange, trailing, in_range, parse_event_time, ts_literal,
)
