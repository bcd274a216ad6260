from tidemark.functions.expr import (  # noqa: F401
    SURROGATE_NULL_TOKEN,
    add_surrogate_key,
    as_of_date,
    as_of_timestamp,
    calendar_parts,
    day_of_week_sun0,
    days_before,
    json_text,
    label_map,
    lenient_double,
    nan_to_null,
    safe_pct_change,
    strict_date,
    strict_double,
    strict_long,
    surrogate_key,
    tier,
    typed_null,
)
