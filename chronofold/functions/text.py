"""Value texts: number formatting, rounding inside a text, digit spacing, digit runs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns the rendered text must agree on.
DECIMAL_PATTERN = r"\d*\.\d+"
DIGIT_RUN_PATTERN = r"[0-9]+(?:[.][0-9]*)?|[.]+"
DIGIT_CHAR_PATTERN = r"[0-9.]"
ALL_DIGITS_PATTERN = r"^\d+$"
FOUR_PLACES = "0.0###"


def _four_places(x: Column) -> Column:
    # DecimalFormat rounds the exact binary value half-even, which is what a
    # correctly rounded round(x, 4) gives; 5e-05 is its one miss.
    return F.when(F.abs(x) == F.lit(5e-05), F.lit("0.0001")).otherwise(
        F.call_function("format_number", x, F.lit(FOUR_PLACES))
    )


def _mantissa(x: Column) -> Column:
    return F.regexp_extract(x.cast("string"), r"^-?([0-9.]+)E", 1)


def _exponent(x: Column) -> Column:
    text = x.cast("string")
    digits = F.regexp_extract(text, r"E-?([0-9]+)$", 1)
    sign = F.when(text.contains("E-"), F.lit("e-")).otherwise(F.lit("e+"))
    return F.concat(sign, F.when(F.length(digits) < 2, F.concat(F.lit("0"), digits)).otherwise(digits))


def _not_finite(x: Column) -> Column:
    return (
        F.when(F.isnan(x), F.lit("nan"))
        .when(x == F.lit(float("inf")), F.lit("inf"))
        .when(x == F.lit(float("-inf")), F.lit("-inf"))
    )


def float_text(x: Column) -> Column:
    """Shortest text of a double with its decimals rounded to four places.

    Plain notation from 1e-4 up to 1e16, otherwise ``d.dde-05`` with only the mantissa rounded.
    """
    x = x.cast("double")
    size = F.abs(x)
    plain = (x == 0) | ((size >= F.lit(1e-4)) & (size < F.lit(1e16)))
    mantissa = _mantissa(x)
    rounded = F.when(mantissa.endswith(".0"), F.regexp_replace(mantissa, r"\.0$", "")).otherwise(
        _four_places(mantissa.try_cast("double"))
    )
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    return F.when(plain, _four_places(x)).otherwise(
        F.coalesce(_not_finite(x), F.concat(sign, rounded, _exponent(x)))
    )


def shortest_text(x: Column) -> Column:
    """Shortest text of a positive double from 1e16 up that reads back as the same number: ``1.25e+17``.

    The JVM's own text reads back, but may have some digits too many. Its digits are cut by four to one, the nearer neighbour first;
    the first that is still the same number is taken.
    """
    text = x.cast("string")
    digits = F.regexp_replace(F.translate(F.regexp_extract(text, r"^([0-9.]+)E", 1), ".", ""), "0+$", "")
    size, number = F.length(digits), digits.cast("bigint")
    unit = F.regexp_extract(text, r"E([0-9]+)$", 1).cast("int") - size + 1  # power of ten of the last digit
    cuts = []
    for k in range(4, 0, -1):
        low, rest = F.floor(number / F.lit(10**k).cast("decimal(6,0)")), number % 10**k
        # Half-way by the digits shown: the whole number itself decides where it fits a long.
        half = F.concat((low * 2 + 1).cast("string"), F.lit("E"), (unit + k).cast("string")).try_cast("decimal(38,0)")
        above = F.coalesce(x.try_cast("bigint").cast("decimal(38,0)") * 2 > half, F.lit(True))
        up = F.when(rest * 2 == 10**k, above).otherwise(rest * 2 > 10**k).cast("int")
        cuts += [F.when(size > k, F.concat((low + n).cast("string"), F.lit("E"), (unit + k).cast("string"))) for n in (up, 1 - up)]
    same = F.filter(F.array(*cuts), lambda c: c.cast("double") == x)
    best = F.coalesce(F.get(same, F.lit(0)), F.concat(digits, F.lit("E"), unit.cast("string")))
    kept = F.regexp_extract(best, "^([0-9]+)E", 1)
    power = F.regexp_extract(best, "E(-?[0-9]+)$", 1).cast("int") + F.length(kept) - 1
    kept = F.regexp_replace(kept, "0+$", "")
    mantissa = F.when(F.length(kept) == 1, kept).otherwise(F.concat_ws(".", F.substring(kept, 1, 1), F.substring(kept, 2, 20)))
    return F.concat(mantissa, F.lit("e+"), power.cast("string"))


def _round_piece(x: Column) -> Column:
    big = F.when(x < F.lit(float("inf")), shortest_text(x))
    return F.when(x < F.lit(1e16), _four_places(x)).otherwise(F.coalesce(_not_finite(x), big))


def round_decimals(text: Column) -> Column:
    """Round every decimal number inside a text to four places and keep the rest.

    Numbers from 1e16 up have no decimals left and turn to ``d.dde+16`` form.
    """
    gaps = F.split(text, DECIMAL_PATTERN, -1)
    numbers = F.regexp_extract_all(text, F.lit(f"({DECIMAL_PATTERN})"), F.lit(1)).cast("array<double>")
    joined = F.array_join(
        F.zip_with(gaps, numbers, lambda g, x: F.when(x.isNull(), g).otherwise(F.concat(g, _round_piece(x)))),
        "",
    )
    return F.when(text.rlike(r"\.\d"), joined).otherwise(text)


def value_text(column: Column, data_type: T.DataType) -> Column:
    """Text of one event field before digit spacing, decimals rounded; null stays null."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.when(column.isNotNull(), float_text(column))
    if isinstance(data_type, T.BooleanType):
        return F.initcap(column.cast("string"))
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)):
        return column.cast("string")
    if isinstance(data_type, (T.TimestampNTZType, T.TimestampType)):
        fraction = F.date_format(column, "SSSSSS")
        seconds = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        return round_decimals(
            F.when(fraction == "000000", seconds).otherwise(F.concat_ws(".", seconds, fraction))
        )
    return round_decimals(column.cast("string"))


def space_digits(text: Column) -> Column:
    """Put one space on both sides of every digit and dot."""
    return F.regexp_replace(text, f"({DIGIT_CHAR_PATTERN})", " $1 ")


def digit_runs(text: Column) -> Column:
    """The numbers and dot groups of a text, in order."""
    return F.regexp_extract_all(text, F.lit(f"({DIGIT_RUN_PATTERN})"), F.lit(1))


def place_ids(run: Column) -> Column:
    """Digit-place ids of one run: units are 6, the dot 5, decimals 4 and down.

    A run with two dots or more has no places.
    """
    n = F.length(run)
    dots = n - F.length(F.replace(run, F.lit("."), F.lit("")))
    top = F.when(dots == 0, n + 5).otherwise(F.instr(run, ".") + 4)
    return F.when(dots > 1, F.array_repeat(F.lit(0), n)).otherwise(F.sequence(top, top - n + 1, F.lit(-1)))


def text_place_ids(text: Column) -> Column:
    """Place ids of all digit and dot characters of a text, in order."""
    return F.flatten(F.transform(digit_runs(text), place_ids))
