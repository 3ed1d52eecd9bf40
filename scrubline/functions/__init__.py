"""Column expressions. All of them are built-in Spark functions, without UDFs,
and give NULL instead of an error on bad input, with ANSI mode on or off."""

from scrubline.functions.convert import (
    amount_to_double,
    digits_to_integer,
    is_non_numeric,
    long_date,
    percentage,
    to_double,
    to_score,
)
from scrubline.functions.missing import (
    AUDIT,
    BLANK,
    EMPTY,
    NAN,
    NULL,
    Missing,
    is_missing,
    is_nan_text,
    nan_to_null,
)
from scrubline.functions.text import (
    clean_length,
    clean_length_between,
    clean_text,
    has_clean_length,
    normalize_label,
    show_text,
    squeeze_spaces,
    strip_punctuation,
    words,
)

__all__ = [
    "AUDIT",
    "BLANK",
    "EMPTY",
    "NAN",
    "NULL",
    "Missing",
    "amount_to_double",
    "clean_length",
    "clean_length_between",
    "clean_text",
    "digits_to_integer",
    "has_clean_length",
    "is_missing",
    "is_nan_text",
    "is_non_numeric",
    "long_date",
    "nan_to_null",
    "normalize_label",
    "percentage",
    "show_text",
    "squeeze_spaces",
    "strip_punctuation",
    "to_double",
    "to_score",
    "words",
]
