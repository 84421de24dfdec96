from datetime import datetime, timedelta

EPOCH = datetime(2024, 1, 1)


def at(minutes: float) -> datetime:
    return EPOCH + timedelta(minutes=minutes)


def events_df(spark, rows, extra: str = ""):
    """rows: (subject, minutes or datetime or None, code, value, seq, *extra)."""
    fixed = [
        (r[0], at(r[1]) if isinstance(r[1], (int, float)) else r[1], r[2], r[3], r[4], *r[5:]) for r in rows
    ]
    schema = "subject_id bigint, time timestamp_ntz, code string, numeric_value double, seq bigint" + extra
    return spark.createDataFrame(fixed, schema)


def labels_df(spark, rows, extra: str = ""):
    fixed = [(r[0], at(r[1]) if isinstance(r[1], (int, float)) else r[1], *r[2:]) for r in rows]
    return spark.createDataFrame(
        fixed, "subject_id bigint, prediction_time timestamp_ntz, boolean_value boolean" + extra
    )


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
