"""Ordered-rule classes of non-numeric result values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rules in order, the first match wins. Values are trimmed and lower-cased first.
CATEGORY_RULES = [
    ("placeholder", r"^\s*\.*\s*$"),
    ("not_detected", r"not detected|non ?reactive|^nd\b"),
    ("detected", r"detected|reactive"),
    ("positive", r"positive"),
    ("negative", r"negative|^neg$"),
    ("trace", r"trace"),
    ("presence_absence", r"\bpresent\b|\babsent\b|\bno (significant )?growth\b"),
    ("ordinal_plus", r"^[1-4]\+$"),
    ("comment_or_report", r"see (comment|note)|^note$|reference interval|test not performed|report"),
    ("error_flag", r"invalid|cancel"),
    ("percentage", r"^\d+(\.\d+)?\s*%$"),
    ("inequality", r"^[<>]=?\s*\d"),
    ("unit_suffix", r"^\d+(\.\d+)?\s*[a-z][a-z/]*$"),
]
CATEGORY_DEFAULT = "other"

ORGANISMS = (
    "escherichia",
    "klebsiella",
    "candida",
    "staphylococcus",
    "pseudomonas",
    "proteus",
    "enterococcus",
    "streptococcus",
)
BUCKET_DEFAULT = "unknown"


def bucket_rules(organisms: tuple[str, ...] = ORGANISMS) -> list[tuple[str, str]]:
    return [
        ("ordinal", r"^[1-4]\+$|trace"),
        ("binary", r"negative|positive|detected|reactive|^present$|^absent$"),
        ("organism", r"\b(" + "|".join(organisms) + r")\b"),
        ("numeric_like", r"^[<>]=?\s*[\d.,:]+$|^\d+(\.\d+)?\s*%$"),
        ("free_text", r"\b[a-z]{3,}\b.*\s[a-z]{3,}\b"),
        ("units_as_values", r"^[a-z][a-z0-9]*$"),
    ]


def first_rule(value: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """Name of the first rule whose pattern is found in the value, else the default; never null."""
    text = F.lower(F.trim(value))
    chosen = F
    for name, pattern in rules:
        chosen = chosen.when(text.rlike(pattern), name)
    return chosen.otherwise(default)


def category(value: Column) -> Column:
    """Fourteen result-value categories."""
    return first_rule(value, CATEGORY_RULES, CATEGORY_DEFAULT)


def bucket(value: Column, organisms: tuple[str, ...] = ORGANISMS) -> Column:
    """Seven result-value buckets."""
    return first_rule(value, bucket_rules(organisms), BUCKET_DEFAULT)
