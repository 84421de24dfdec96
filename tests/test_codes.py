from chronofold.operators import codes
from tests.helpers import events_df, rows_of


def dictionaries(spark):
    items = spark.createDataFrame([("7", "First"), ("8", "Only first")], "itemid string, label string")
    lab = spark.createDataFrame([("7", "Second"), ("50912", "Creatinine"), ("9", None)], "itemid string, label string")
    return items, lab


def used(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "code string")


def test_description_replaces_the_code_unless_empty_or_null(spark):
    meta = spark.createDataFrame([("A", "Alpha"), ("B", ""), ("C", None)], "code string, description string")
    got = rows_of(codes.resolve_codes(used(spark, "A", "B", "C", "D"), meta), "code", "code_text", "resolution")
    assert got == [("A", "Alpha", "description"), ("B", "B", "plain"), ("C", "C", "plain"), ("D", "D", "plain")]


def test_first_numeric_segment_is_looked_up(spark):
    items, lab = dictionaries(spark)
    names = ["LAB//50912//mg", "X//7", "8", "X//5//7", "X//7a", "X//9", "X////7"]
    got = {r.code: (r.code_text, r.resolution) for r in codes.resolve_codes(used(spark, *names), None, items, lab).collect()}
    assert got == {
        "LAB//50912//mg": ("LAB//Creatinine//mg", "lab_items"),
        "X//7": ("X//First", "items"),
        "8": ("Only first", "items"),
        "X//5//7": ("X//5//7", "none"),
        "X//7a": ("X//7a", "plain"),
        "X//9": ("X//9", "none"),
        "X////7": ("X////First", "items"),
    }


def test_dictionaries_count_only_together(spark):
    items, _ = dictionaries(spark)
    assert rows_of(codes.resolve_codes(used(spark, "X//7"), None, items, None), "code_text", "resolution") == [("X//7", "none")]


def test_unresolved_report(spark):
    events = events_df(spark, [(1, 0, c, 1.0, i) for i, c in enumerate(["X//5", "X//5", "X//7", "plain", "D//1", None])])
    meta = spark.createDataFrame([("D//1", "Described")], "code string, description string")
    items, lab = dictionaries(spark)
    assert rows_of(codes.unresolved_codes(events, meta, items, lab), "code", "n_rows") == [("X//5", 2)]
    assert rows_of(codes.unresolved_codes(events, meta), "code", "n_rows") == [("X//5", 2), ("X//7", 1)]


def test_events_keep_null_codes(spark):
    events = events_df(spark, [(1, 0, "X//7", 1.0, 1), (1, 0, None, 1.0, 2)])
    items, lab = dictionaries(spark)
    resolved = codes.resolve_codes(codes.code_table(events), None, items, lab)
    got = {r.seq: r.code_text for r in codes.describe_events(events, resolved).collect()}
    assert got == {1: "X//First", 2: None}


def test_repeated_keys_do_not_multiply(spark):
    meta = spark.createDataFrame([("A", "one"), ("A", "two"), ("A", ""), ("B", None)], "code string, description string")
    items = spark.createDataFrame([("7", "x"), ("7", "y")], "itemid string, label string")
    got = codes.resolve_codes(used(spark, "A", "B", "X//7"), meta, items, items)
    assert rows_of(got, "code", "code_text") == [("A", "two"), ("B", "B"), ("X//7", "X//y")]
