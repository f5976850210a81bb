from arrivals.functions.columns import (
    day_number_to_date,
    normalise_text,
    parse_date,
    recode,
    substring_from,
    text_to_double,
    text_to_int,
    upper_case,
)

__all__ = [
    "day_number_to_date", "normalise_text", "parse_date", "recode", "substring_from",
    "text_to_double", "text_to_int", "upper_case",
]
