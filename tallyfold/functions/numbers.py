"""Rounding, rates, money and their text forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Dollars for a million tokens in and out.
PRICE_IN, PRICE_OUT = 0.50, 2.50


def round_half_away(x: Column, digits: int) -> Column:
    """Rounds ties away from zero in binary arithmetic, as DuckDB does; F.round works on the decimal text."""
    scale = float(10**digits)
    return F.signum(x) * F.floor(F.abs(x) * scale + 0.5) / scale


def rate(part: Column, whole: Column, digits: int = 4) -> Column:
    """part / whole, rounded; null where the whole is 0."""
    return round_half_away(F.try_divide(part.cast("double"), whole.cast("double")), digits)


def percent_text(x: Column) -> Column:
    """0.5105 as 51.0%."""
    return F.concat(F.format_number(x * 100, 1), F.lit("%"))


def signed_text(x: Column) -> Column:
    """0.145 as +0.145."""
    return F.format_string("%+.3f", x)


def token_cost(tokens_in: Column, tokens_out: Column, price_in: float = PRICE_IN, price_out: float = PRICE_OUT) -> Column:
    return tokens_in / 1e6 * price_in + tokens_out / 1e6 * price_out


def duration_text(seconds: Column) -> Column:
    """45s, 2m 5s, 1h 0m 5s, whole seconds."""
    s = F.floor(seconds).cast("long")
    h, m, r = F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60
    return F.when(s < 60, F.format_string("%ds", s)).when(s < 3600, F.format_string("%dm %ds", m, r)).otherwise(F.format_string("%dh %dm %ds", h, m, r))


def _one_digit(x: Column) -> Column:
    return F.call_function("format_number", x.cast("double"), F.lit("0.0"))


def size_text(size: Column) -> Column:
    """Bytes with one decimal in the unit that leaves less than 1024."""
    out = F.concat(_one_digit(size / float(1024**4)), F.lit(" TB"))
    for k, unit in ((3, "GB"), (2, "MB"), (1, "KB"), (0, "B")):
        out = F.when(size < float(1024 ** (k + 1)), F.concat(_one_digit(size / float(1024**k)), F.lit(f" {unit}"))).otherwise(out)
    return out


def tokens_of_chars(chars: Column, prompt: Column | int) -> Column:
    """Tokens that a text and its prompt are estimated at."""
    return chars / 4 + prompt
