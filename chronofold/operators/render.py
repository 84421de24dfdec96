"""Events to text: the fields that are shown, in order, with digits set apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.functions.text import space_digits, value_text
from chronofold.schema import CODE, rendered_columns


def field_texts(events: DataFrame, skip: list[str] | None = None) -> list[tuple[str, Column]]:
    """(column name, value text before digit spacing) of every rendered column.

    ``events`` may carry ``code_text``, which then stands for the code.
    """
    shown = CODE if "code_text" not in events.columns else "code_text"
    plain = events.drop("code_text", "code_words", "resolution")
    return [
        (c, F.col(shown).cast("string") if c == CODE else value_text(F.col(c), events.schema[c].dataType))
        for c in rendered_columns(plain, skip)
    ]


def event_text(events: DataFrame, skip: list[str] | None = None) -> Column:
    """``name value name value ...`` without null fields; empty if every field is null.

    The code is shown as it is, in all other values each digit and dot stands alone.
    """
    return F.concat_ws(
        " ",
        *[
            F.concat(F.lit(name + " "), text if name == CODE else space_digits(text))
            for name, text in field_texts(events, skip)
        ],
    )


def render_events(events: DataFrame, skip: list[str] | None = None) -> DataFrame:
    """Add ``event_text``; events without any field to show are dropped."""
    return events.withColumn("event_text", event_text(events, skip)).where("event_text <> ''")
