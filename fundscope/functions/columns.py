"""Scalar column rules of the cleaning jobs, as native Catalyst expressions.

The jobs this library rebuilds wrote several of these as Scala UDFs; here each
one is an expression, so it folds, pushes down and stays in whole-stage
codegen.  Every function takes column names or ``Column`` objects and returns
a ``Column``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the rules depend on.
SENTINEL_TEXT = "false"              # text that means "missing" in the raw CSV
CURRENCY_CODE_LENGTH = 3             # a valid currency code has three characters
SECONDS_PER_HOUR = 3600
SECONDS_PER_DAY = 86400
EPOCH_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
QUOTE_RUN_PATTERN = '"{2,}'          # two or more double quotes in a row
TOKEN_GAP_PATTERN = r"\W+"           # tokenizer gap: a run of non-word characters
NULL_WORD = "null"                   # how string concatenation prints a null

EPOCH_NTZ_TEXT = "1970-01-01 00:00:00"


def _epoch_ntz() -> Column:
    # A string cast to timestamp_ntz carries no zone; a Python datetime literal
    # would be a zoned TIMESTAMP and shift with the session time zone.
    return F.lit(EPOCH_NTZ_TEXT).cast("timestamp_ntz")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- casts

def tolerant_int(col) -> Column:
    """Text or number to int; bad text gives null and ``99.5`` gives 99.

    ANSI casts raise on bad text and ``try_cast('99.5' as int)`` is null, so
    go through double (truncating toward zero, as the old integer cast did).
    """
    return _c(col).try_cast("double").try_cast("int")


def sentinel_to_null(col, sentinel: str = SENTINEL_TEXT) -> Column:
    return F.nullif(_c(col), F.lit(sentinel))


def null_or_zero_to_sentinel(col, sentinel: float = -1.0) -> Column:
    c = _c(col).cast("double")
    return F.when(F.coalesce(c, F.lit(0.0)) == 0, F.lit(sentinel)).otherwise(c)


# ---------------------------------------------------------------- repairs

def repair_country(country="country", currency="currency") -> Column:
    """A missing country takes the currency value (they were swapped)."""
    return F.coalesce(_c(country), _c(currency))


def validate_currency(currency="currency", width: int = CURRENCY_CODE_LENGTH) -> Column:
    """Keep only codes of ``width`` characters; anything else becomes null."""
    c = _c(currency)
    return F.when(F.length(c) == width, c)


def collapse_quote_runs(col, replacement: str = " ") -> Column:
    """Runs of two or more double quotes become one space."""
    return F.regexp_replace(_c(col), QUOTE_RUN_PATTERN, replacement)


# ---------------------------------------------------------------- time

def ntz_to_epoch(col) -> Column:
    """Seconds since 1970-01-01 00:00:00 of a zone-less timestamp (bigint)."""
    return F.timestamp_diff("SECOND", _epoch_ntz(), _c(col).cast("timestamp_ntz"))


def epoch_to_text(col, tz: str | None = "UTC", fmt: str = EPOCH_TEXT_FORMAT) -> Column:
    """Epoch seconds to text.

    ``tz=None`` follows the session time zone (``from_unixtime``); a zone name
    makes the result independent of the session.
    """
    if tz is None:
        return F.from_unixtime(_c(col), fmt)
    local = F.timestamp_add("SECOND", _c(col).cast("bigint"), _epoch_ntz())
    if tz.upper() not in ("UTC", "ETC/UTC", "Z", "GMT"):
        local = F.convert_timezone(F.lit("UTC"), F.lit(tz), local)
    return F.date_format(local, fmt)


def calendar_days(end_text, start_text) -> Column:
    """Calendar-day difference of two date or date-time texts."""
    return F.datediff(_c(end_text), _c(start_text))


def hours_between(end_epoch, start_epoch, digits: int = 3) -> Column:
    """round((end - start) / 3600.0, digits); 64-bit subtraction, no overflow."""
    diff = _c(end_epoch).cast("bigint") - _c(start_epoch).cast("bigint")
    return F.round(diff / F.lit(float(SECONDS_PER_HOUR)), digits)


def elapsed_whole_days(end_epoch, start_epoch, missing: int = -1) -> Column:
    """Whole 86,400-second units, truncated toward zero; ``missing`` on null."""
    diff = _c(end_epoch).cast("bigint") - _c(start_epoch).cast("bigint")
    return F.coalesce(truncated_div(diff, SECONDS_PER_DAY).cast("int"), F.lit(missing))


def elapsed_whole_hours(end_epoch, start_epoch, missing: float = -1.0) -> Column:
    """Whole hours (integer division by 3600) widened to double; ``missing`` on null."""
    diff = _c(end_epoch).cast("bigint") - _c(start_epoch).cast("bigint")
    return F.coalesce(truncated_div(diff, SECONDS_PER_HOUR).cast("double"),
                      F.lit(missing))


def truncated_div(col, divisor: int) -> Column:
    """Integer division truncating toward zero (the JVM rule), exact over the whole bigint range."""
    return F.call_function("div", _c(col).cast("bigint"), F.lit(divisor).cast("bigint"))


# ---------------------------------------------------------------- text

def concat_text(*cols, sep: str = " ") -> Column:
    """Join texts with ``sep``; null parts are skipped."""
    return F.concat_ws(sep, *[_c(c) for c in cols])


def concat_text_null_literal(*cols, sep: str = " ") -> Column:
    """Join texts with ``sep``; a null part is printed as the word ``null``."""
    return F.concat_ws(sep, *[F.coalesce(_c(c), F.lit(NULL_WORD)) for c in cols])


def split_lines(col) -> Column:
    """A text to its lines, split the way the line reader splits a file."""
    return F.split(_c(col), r"\r\n|\r|\n")


def split_on_space(col) -> Column:
    """Split a line on single spaces with the JVM ``String.split(" ")`` rule.

    Inner and leading empty words are kept, trailing ones dropped; an empty
    line gives one empty word, a line of spaces gives none.  ``rtrim`` removes
    trailing spaces only, which is exactly the set of trailing empty words.
    """
    c = _c(col)
    return (F.when(c == "", F.array(F.lit("")))
            .when(F.rtrim(c) == "", F.array().cast("array<string>"))
            .otherwise(F.split(F.rtrim(c), " ")))


def regex_tokens(col, pattern: str = TOKEN_GAP_PATTERN, to_lower: bool = True,
                 min_length: int = 1) -> Column:
    """Tokens between matches of ``pattern`` (same result as RegexTokenizer
    with ``gaps=True``)."""
    c = F.lower(_c(col)) if to_lower else _c(col)
    return F.filter(F.split(c, pattern), lambda t: F.length(t) >= min_length)


def drop_stop_words(tokens_col, stop_words, case_sensitive: bool = False) -> Column:
    """Remove stop words from a token array, keeping order and repeats."""
    words = list(stop_words)
    if case_sensitive:
        return F.filter(_c(tokens_col), lambda t: ~t.isin(words))
    lowered = sorted({w.lower() for w in words})
    return F.filter(_c(tokens_col), lambda t: ~F.lower(t).isin(lowered))
