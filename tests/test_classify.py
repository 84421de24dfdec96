import pytest
from pyspark.sql import functions as F

from chronofold.functions.classify import bucket, category
from chronofold.operators import profile

# Result texts with the classes they belong to.
CATEGORIES = {
    "other": ["Candida albicans", "Contamination suspected; Submit new specimen", ": ...", "INDETERMINATE-IMPAIRED",
              "NO METHICILLIN-RESISTANT STAPH AUREUS ISOLATED", "Moderate Pseudomonas aeruginosa"],
    "detected": ["Detected", "Reactive", "NONE DETECTED", "NO DNA DETECTED", "NONE DETECTED mcg/mL", "Reactive cellular changes."],
    "placeholder": ["...", ""],
    "presence_absence": ["Present", "No Growth at 1:1000 dilution", "No Significant Growth", "No Growth Undiluted",
                         "Lactobacillus present in large numbers. Probable Contaminant."],
    "not_detected": ["Not Detected", "Nonreactive", "2019-nCoV Not Detected", "ND", "Non reactive", "ND 6L"],
    "percentage": ["30%", "100%"],
    "negative": ["Negative", "neg", "Negative: No eosinophils seen.", "Few Lactose Negative Gram Negative Rod",
                 "Negative by antigen detection assay."],
    "positive": ["POSITIVE", "Lactose Positive Gram Negative Rod", "20,000 CFU/mL Lactose Positive Gram Negative Rod", "Low positive <=5%"],
    "comment_or_report": ["See Comment", "Reference Intervals", "Test Not Performed", "NOTE", "See Notes",
                          "CONTROL WELL. DRUG TERMINATED. REPORTING UCLA MIC"],
    "error_flag": ["Invalid", "cancel", "CANCELED"],
    "ordinal_plus": ["1+", "4+"],
    "unit_suffix": ["2L", "2LNC", "2L/min"],
    "inequality": [">89", "<0.04", "<=5.0", ">100,000 CFU/mL Escherichia coli"],
    "trace": ["Trace", "Trace- 5 mg/dL", "TRACE (0.25 g/dL)", "Hemolyzed Trace", "traCE"],
}
BUCKETS = {
    "units_as_values": ["PERFORMED", "M1M1", "NS", "Yeast", "Equivocal"],
    "ordinal": ["1+", "Trace"],
    "organism": [">100,000 CFU/mL Escherichia coli", "Candida albicans", "Moderate Pseudomonas aeruginosa",
                 ">100,000 CFU/mL Proteus mirabilis"],
    "numeric_like": [">89", "<0.2", "<1:20", "30%", "<=200"],
    "unknown": ["...", ": ...", "INDETERMINATE-IMPAIRED", "2L NC", "VC 30%"],
    "binary": ["Negative", "Not Detected", "Nonreactive", "Present", "Negative for Intraepithelial Lesion or Malignancy."],
    "free_text": ["See Comment", "No Growth at 1:1000 dilution", "See Stain", "Test Not Performed",
                  "NO METHICILLIN-RESISTANT STAPH AUREUS ISOLATED"],
}


@pytest.mark.parametrize("expected, rule", [(CATEGORIES, category), (BUCKETS, bucket)])
def test_golden_values(spark, expected, rule):
    rows = [(v, name) for name, values in expected.items() for v in values]
    df = spark.createDataFrame(rows, "raw string, expected string")
    assert [tuple(r) for r in df.where(rule(F.col("raw")) != F.col("expected")).collect()] == []


def test_organisms_are_a_parameter(spark):
    df = spark.createDataFrame([("Serratia marcescens",)], "raw string")
    assert df.select(bucket(F.col("raw"))).first()[0] == "free_text"
    assert df.select(bucket(F.col("raw"), ("serratia",))).first()[0] == "organism"


def test_summary_partitions_the_rows_and_ranks_examples(spark):
    values = ["Negative"] * 5 + ["neg"] * 2 + ["NEGATIVE"] * 2 + [">1"] * 3 + [None] * 4
    df = spark.createDataFrame([(v,) for v in values], "raw string")
    counts = profile.value_counts(df, "raw")
    classed = profile.classify(counts, category(F.col("raw")), "category")
    got = [tuple(r) for r in profile.class_summary(classed, "category", "raw", "raw", n=2).collect()]
    assert got == [("negative", 9, 3, "Negative | NEGATIVE"), ("inequality", 3, 1, ">1")]
    assert [r.raw for r in profile.top_values(counts, "raw", n=2).collect()] == ["Negative", ">1"]


def test_examples_use_a_group_limit(spark):
    counts = spark.createDataFrame([("a", 1)], "raw string, count bigint")
    plan = profile.class_examples(
        profile.classify(counts, category(F.col("raw")), "category"), "category", "raw"
    )._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
