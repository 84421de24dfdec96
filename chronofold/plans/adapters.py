"""The given tables read as events, labels, codes, dictionaries and result values."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.schema import CODE, SEQ, SUBJECT, TIME, VALUE

# The stream table's event types play the codes; one has no description on purpose.
STREAM_BIRTH = "signup"
STREAM_CODES = [
    ("click", "A link was clicked, by hand"),
    ("error", ""),
    ("purchase", "Goods bought at the till"),
    ("view", "Page seen"),
]

# Sample result texts, one of which each line item is given.
RESULT_TEXTS = [
    "Negative", "See Comment", ">89", "Not Detected", "<0.2", "Nonreactive", "1+", "Trace", "...",
    "Reference Intervals", "2+", "3+", "Present", "Positive", "No Growth at 1:1000 dilution",
    "No Significant Growth", "<=5.0", "Detected", "Reactive", "NOT DETECTED",
    ">100,000 CFU/mL Escherichia coli", "NEGATIVE", "4+", "<1:20",
    "Negative for Intraepithelial Lesion or Malignancy.", "Test Not Performed", "30%",
    "Candida albicans", "Contamination suspected; Submit new specimen", ": ...", "NONE DETECTED",
    "ND", "2L", "2LNC", "2L NC", "VC 30%", "Invalid", "cancel", "Trace- 5 mg/dL",
    "Low positive <=5%", "Lactose Positive Gram Negative Rod", "PERFORMED", "M1M1", "Yeast",
    "INDETERMINATE-IMPAIRED", "neg", "traCE", "",
]

# A small vocabulary by rule: printable ASCII as single characters, alone and as continuations, plus words.
VOCAB_FIRST_CHAR = 106
VOCAB_FIRST_CONTINUATION = 300
VOCAB_FIRST_WORD = 500
VOCAB_WORDS = [
    "code", "numeric", "value", "props", "click", "error", "view", "purchase", "link", "was",
    "Goods", "Page", "seen", "by", "hand", "the", "till", "at", "bought", "LAB", "ring", "widget",
    "##ed", "##ing", "##er", "##ked", "##ught",
]
VOCAB_SPECIAL = [("[PAD]", 0), ("[UNK]", 100), ("[CLS]", 101), ("[SEP]", 102)]


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; its footer is read once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias(SUBJECT),
        F.col("ts").alias(TIME),
        F.col("event_type").alias(CODE),
        F.col("value").alias(VALUE),
        "props",
        F.col("event_id").alias(SEQ),
    )


def stream_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where("event_type = 'purchase'")
        .select(
            F.col("user_id").alias(SUBJECT),
            F.col("ts").alias("prediction_time"),
            (F.col("value") > 100).alias("boolean_value"),
            "event_id",
        )
    )


def stream_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STREAM_CODES, "code string, description string")


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # Made before the join, which then moves these instead of the columns they are made of.
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.concat_ws("//", F.lit("LAB"), line_item(), "l_returnflag").alias(CODE),
        F.col("l_quantity").alias(VALUE),
        line_seq().alias(SEQ),
    )
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias(SUBJECT), F.col("o_orderdate").alias(TIME), CODE, VALUE, SEQ
    )


def line_item():
    """The numeric segment of a line's code: mostly a part, for some lines a supplier, for some neither."""
    supplier = F.concat(F.lit("0"), F.col("l_suppkey").cast("string"))
    unknown = F.concat(F.lit("00"), F.col("l_partkey").cast("string"))
    return (
        F.when(F.col("l_linenumber") == 5, supplier)
        .when(F.col("l_linenumber") == 6, unknown)
        .otherwise(F.col("l_partkey").cast("string"))
    )


def line_seq():
    """A number per line item: order and line, then 22 bits from part, supplier and quantity."""
    tie = F.col("l_partkey") * 64 + F.col("l_suppkey") * 8191 + F.col("l_quantity").cast("bigint")
    return (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * F.lit(1 << 22) + F.pmod(tie, F.lit(1 << 22))


def order_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias(SUBJECT),
        F.col("o_orderdate").alias("prediction_time"),
        (F.col("o_orderstatus") == "F").alias("boolean_value"),
        "o_orderkey",
    )


def part_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First dictionary: all parts."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("itemid"), F.col("p_name").alias("label")
    )


def supplier_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second dictionary: all suppliers, their numbers with a leading zero, unlike any part's."""
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("0"), F.col("s_suppkey").cast("string")).alias("itemid"), F.col("s_name").alias("label")
    )


def result_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result text per line item, with the return flag and status as measurement metadata.

    Some are fixed texts; the others hold a price in cents or a quantity, so that a larger table has more distinct ones.
    """
    n = len(RESULT_TEXTS)
    texts = F.array(*[F.lit(t) for t in RESULT_TEXTS])
    pick = F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber"), F.lit(n + 4))
    quantity = F.col("l_quantity").cast("int").cast("string")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        F.when(pick < n, F.get(texts, pick.cast("int")))
        .when(pick == n, F.concat(F.lit(">"), cents))
        .when(pick == n + 1, F.concat(quantity, F.lit("%")))
        .when(pick == n + 2, F.concat(F.lit("<="), quantity, F.lit(".5")))
        .otherwise(F.concat(cents, F.lit(" mg/dL")))
        .alias("raw"),
        F.concat_ws("/", "l_returnflag", "l_linestatus").alias("meta"),
    )


def vocab_rows() -> list[tuple[str, int]]:
    chars = [chr(c) for c in range(33, 127)]
    return (
        VOCAB_SPECIAL
        + [(c, VOCAB_FIRST_CHAR + i) for i, c in enumerate(chars)]
        + [("##" + c, VOCAB_FIRST_CONTINUATION + i) for i, c in enumerate(chars)]
        + [(w, VOCAB_FIRST_WORD + i) for i, w in enumerate(VOCAB_WORDS)]
    )


def small_vocab(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(vocab_rows(), "token string, id int")
