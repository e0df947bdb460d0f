"""Column expressions shared by the jobs; all of them stay on the JVM side."""

from trendmill.functions.coercion import api_int, digits_to_long, to_boolean, to_long, to_long_or_zero
from trendmill.functions.dates import month_of, parse_trending_date, utc_date, utc_timestamp
from trendmill.functions.metrics import (
    average_from_rate_sums, average_of_counts, average_of_rates, engagement_rate, like_ratio, rate_sums,
)
from trendmill.functions.text import has_text, normalize_region, pipe_join

__all__ = [
    "api_int", "average_from_rate_sums", "average_of_counts", "average_of_rates", "digits_to_long", "engagement_rate", "has_text",
    "like_ratio", "month_of", "normalize_region", "parse_trending_date", "pipe_join",
    "rate_sums", "to_boolean", "to_long", "to_long_or_zero", "utc_date", "utc_timestamp",
]
