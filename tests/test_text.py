import random
from datetime import date, datetime
from decimal import ROUND_HALF_EVEN, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from chronofold.functions import text as tx


def column_of(spark, values, kind, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def by_hand(text):
    """Scan for digits, a point and digits; round the exact binary value of each such number."""
    out, at = [], 0
    while at < len(text):
        point = at
        while point < len(text) and text[point].isdigit():
            point += 1
        end = point + 1
        while end < len(text) and text[end].isdigit():
            end += 1
        if text[point : point + 1] == "." and end > point + 1:
            exact = Decimal(float(text[at:end]))
            with localcontext(prec=60):
                out.append(repr(float(exact.quantize(Decimal("0.0001"), ROUND_HALF_EVEN))))
            at = end
        else:
            out.append(text[at : max(point, at + 1)])
            at = max(point, at + 1)
    return "".join(out)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("a 1.234567 b .5 c", "a 1.2346 b 0.5 c"),
        ("1.2.3", "1.20.3"),
        ("no number", "no number"),
        ("2.00005", "2.0"),
        ("v. 7", "v. 7"),
        ("0.00005", "0.0001"),
        ("", ""),
        ("20000000000000000.5 kg", "2e+16 kg"),
    ],
)
def test_round_decimals_examples(spark, text, expected):
    assert by_hand(text) == expected
    assert column_of(spark, [text], "string", tx.round_decimals) == [expected]


def test_round_decimals_random(spark):
    rng = random.Random(3)
    alphabet = "0123456789.. ab-"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += [f"x{rng.randint(0, 10**rng.randint(1, 11))}.{rng.randint(0, 10**rng.randint(1, 9))}y" for _ in range(2000)]
    assert column_of(spark, texts, "string", tx.round_decimals) == [by_hand(t) for t in texts]


def test_float_text_is_rounded_repr(spark):
    rng = random.Random(5)
    values = [0.0, -0.0, 100.0, 36.6, 1e-4, 9.99e-5, 1e-5, -2.5e-7, 1.23456789e-5, 1e16, 1.5e16, 123456789012345680.0,
              1e22, 1.23456789e300, 9999999999999998.0, 2.00005, 0.12345, float("inf"), float("-inf"), float("nan")]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-8, 18) for _ in range(3000)]
    values += [round(rng.uniform(-100, 100), 5) for _ in range(3000)]
    assert column_of(spark, values, "double", tx.float_text) == [by_hand(str(v)) for v in values]


def test_float_column_uses_the_widened_value(spark):
    df = spark.createDataFrame([(36.6,)], "v float")
    out = df.select(tx.value_text(F.col("v"), df.schema["v"].dataType)).first()[0]
    assert out == "36.6"


def test_value_text_of_other_types(spark):
    df = spark.createDataFrame(
        [(True, 7, date(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 7, 179575), datetime(2024, 1, 2), Decimal("1.50"), None)],
        "b boolean, n bigint, d date, t timestamp_ntz, t0 timestamp_ntz, x decimal(10,2), s string",
    )
    out = df.select(*[tx.value_text(F.col(f.name), f.dataType) for f in df.schema.fields]).first()
    shown = [True, 7, date(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 7, 179575), datetime(2024, 1, 2), Decimal("1.50")]
    assert list(out[:6]) == [by_hand(str(v)) for v in shown]
    assert out[6] is None


def test_digit_spacing(spark):
    assert column_of(spark, ["36.6", "a1b"], "string", tx.space_digits) == [" 3  6  .  6 ", "a 1 b"]


@pytest.mark.parametrize(
    "text, places",
    [
        ("12345", [10, 9, 8, 7, 6]),
        ("12345.6789", [10, 9, 8, 7, 6, 5, 4, 3, 2, 1]),
        (".", [5]),
        ("...", [0, 0, 0]),
        ("1.", [6, 5]),
        (".5", [5, 6]),
        ("1.2.3", [6, 5, 4, 5, 6]),
        ("a", []),
        ("7 and 12", [6, 7, 6]),
    ],
)
def test_place_ids(spark, text, places):
    assert column_of(spark, [text], "string", tx.text_place_ids) == [places]


def test_large_numbers_have_their_shortest_text(spark):
    rng = random.Random(16)
    values = [rng.uniform(1, 10) * 10 ** rng.randint(16, 19) for _ in range(3000)]
    values += [rng.uniform(1, 10) * 10 ** rng.randint(16, 300) for _ in range(1000)]
    values += [1e16, 2e16, 1e22, 1e23, 9.999999999999999e22, 9007199254740993e3, 1.7976931348623157e308, 99999999999999990000.0, 2.0**60, 2.0**900]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = {r.x: r.t for r in df.select("x", tx.shortest_text(F.col("x")).alias("t")).collect()}
    assert [found[v] for v in values] == [repr(v) for v in values]
    row = spark.createDataFrame([("a 123456789012345678.25 b 1e5 99999999999999999999.5",)], "t string").select(tx.round_decimals(F.col("t"))).first()
    assert row[0] == "a 1.2345678901234568e+17 b 1e5 1e+20"

