"""Column helpers (built-in expressions only)."""

from crease.functions.columns import (  # noqa: F401
    BOWLER_WICKETS,
    SURROGATE_KEY_NULL,
    batted_first,
    count_when,
    file_name,
    first_of,
    half_up_decimal,
    half_up_rate,
    legal_ball,
    match_id_from_filename,
    opponent,
    ordered_concat,
    outcome_type,
    overs_display,
    result_text,
    surrogate_key,
)
