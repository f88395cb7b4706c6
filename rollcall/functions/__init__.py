"""Column -> Column rules. Built-in functions only; nothing here needs a session."""

from rollcall.functions.bands import (
    age_generation,
    engagement_cohort,
    engagement_score,
    recency_status,
)
from rollcall.functions.dates import (
    as_date,
    as_timestamp,
    days_since,
    month_floor,
    parse_flexible_date,
    years_since,
)
from rollcall.functions.numbers import conditional_count, pct_of, round_half_away
from rollcall.functions.rules import (
    bounded_or_null,
    default_if_null,
    email_plausible,
    missing_data_flag,
    normalize_gender,
    out_of_range_flag,
    standardize_state,
)
from rollcall.functions.text import safe_int_cast, trim_lower, trim_text, trim_upper

__all__ = [
    "age_generation", "as_date", "as_timestamp", "bounded_or_null", "conditional_count",
    "days_since", "default_if_null", "email_plausible", "engagement_cohort",
    "engagement_score", "missing_data_flag", "month_floor", "normalize_gender",
    "out_of_range_flag", "parse_flexible_date", "pct_of", "recency_status",
    "round_half_away", "safe_int_cast", "standardize_state", "trim_lower", "trim_text",
    "trim_upper", "years_since",
]
