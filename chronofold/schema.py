"""The event, label, code and sample tables every operator works on.

events   subject_id BIGINT, time TIMESTAMP_NTZ, code STRING, numeric_value DOUBLE,
         seq BIGINT (input order, unique per event) and any extra columns
labels   subject_id BIGINT, prediction_time TIMESTAMP_NTZ, boolean_value BOOLEAN, ignored columns
codes    code STRING, description STRING
items    itemid STRING, label STRING
vocab    token STRING, id INT
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names and constants that results depend on.
BIRTH_CODE = "MEDS_BIRTH"
LABEL_COLUMN = "boolean_value"
CODE_SEPARATOR = "//"
SPLIT_NAMES = ("train", "tuning", "held_out")
MAX_EVENT_LENGTH = 128
EVENTS_PER_SHARD = 2_000_000
DEBUG_GROUPS = 5000
DEBUG_EVENTS = 100

SUBJECT, TIME, CODE, VALUE, SEQ = "subject_id", "time", "code", "numeric_value", "seq"

EVENT_SCHEMA = T.StructType(
    [
        T.StructField(SUBJECT, T.LongType()),
        T.StructField(TIME, T.TimestampNTZType()),
        T.StructField(CODE, T.StringType()),
        T.StructField(VALUE, T.FloatType()),
    ]
)
CODES_SCHEMA = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("parent_codes", T.ArrayType(T.StringType())),
    ]
)
SPLITS_SCHEMA = T.StructType(
    [T.StructField(SUBJECT, T.LongType()), T.StructField("split", T.StringType())]
)

# Columns that are never rendered as extra event fields.
_NOT_RENDERED = (SUBJECT, TIME, CODE, VALUE, SEQ, "cohort_end", "cohort_label")


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Fail early, naming the columns a table lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")
    return df


def rest_columns(events: DataFrame) -> list[str]:
    """Extra event columns in the order of the input schema."""
    return [c for c in events.columns if c not in _NOT_RENDERED]


def rendered_columns(events: DataFrame, skip: list[str] | None = None) -> list[str]:
    """Columns that go into the event text: code, numeric_value, then the rest.

    A name that contains ``id`` is left out; the test is on the substring, so ``width``
    goes too. Pass ``skip`` to leave out an exact list instead.
    """
    names = [CODE, VALUE, *rest_columns(events)]
    names = [c for c in names if c in events.columns]
    if skip is not None:
        return [c for c in names if c not in skip]
    return [c for c in names if "id" not in c]


def conform(df: DataFrame, schema: T.StructType = EVENT_SCHEMA, keep_extra: bool = True) -> DataFrame:
    """Final column types and order; absent columns become typed nulls, extras follow."""
    have = set(df.columns)
    cols = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    if keep_extra:
        cols += [F.col(c) for c in df.columns if c not in set(schema.names)]
    return df.select(*cols)
