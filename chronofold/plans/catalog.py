"""The registered queries: each operator run over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofold.functions import text as text_fn
from chronofold.functions.classify import bucket, category
from chronofold.functions.clock import second_text
from chronofold.functions.wordpiece import words_of
from chronofold.operators import audit, codes, encode, events, extract, labels, profile, render, samples, shards, splits, store
from chronofold.plans import adapters as ad
from chronofold.schema import CODE, MAX_EVENT_LENGTH, SEQ, SUBJECT, TIME, VALUE
from chronofold.sources.readers import file_preview, split_from_path
from chronofold.sources.staging import staged, staging_root
from chronofold.sources.writers import read_event_blocks, write_event_blocks

Query = Callable[[SparkSession, str], DataFrame]

SHARD_BUDGET = 2000
N_SHARDS = 8
MAX_LENGTH = MAX_EVENT_LENGTH
TAIL = 20
EVENTS_PER_BUCKET = 100_000


def _joined(column: str | Column, separator: str = ",") -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.array_join(column.cast("array<string>"), separator)


def _times(column: str) -> Column:
    return F.array_join(F.transform(column, second_text), ",")


def _clean(spark: SparkSession, d: str) -> DataFrame:
    return events.clean_events(ad.stream_events(spark, d), ad.STREAM_BIRTH)


def _labels(spark: SparkSession, d: str) -> DataFrame:
    return labels.clean_labels(ad.stream_labels(spark, d))


def _headers(spark: SparkSession, d: str) -> DataFrame:
    return labels.sample_headers(_clean(spark, d), _labels(spark, d))


def _numbered(spark: SparkSession, d: str) -> DataFrame:
    return labels.number_samples(_clean(spark, d), _labels(spark, d))


def _placed_orders(spark: SparkSession, d: str) -> DataFrame:
    """Subject, time and seq of the order events, joined once and written, for queries that read them more than once."""
    return staged(ad.order_events(spark, d).select(SUBJECT, TIME, SEQ), "order-events")


def _order_numbered(spark: SparkSession, d: str) -> DataFrame:
    return labels.number_samples(ad.order_events(spark, d), _order_labels(spark, d))


def _order_labels(spark: SparkSession, d: str) -> DataFrame:
    return labels.clean_labels(ad.order_labels(spark, d))


def _order_headers(spark: SparkSession, d: str) -> DataFrame:
    return labels.sample_headers(ad.order_events(spark, d), _order_labels(spark, d))


# Samples

def sample_events(spark, d):
    return samples.sample_events(_clean(spark, d), _numbered(spark, d), _labels(spark, d)).select(
        "sample_id", SEQ, "event_time", "minute", "copy_no"
    )


def sample_events_orders(spark, d):
    rows = samples.sample_events(
        ad.order_events(spark, d), _order_numbered(spark, d), _order_labels(spark, d)
    )
    return rows.select("sample_id", SEQ, "event_time", "minute", "copy_no")


def sample_headers(spark, d):
    return splits.add_split(_headers(spark, d)).select(
        "sample_id", SUBJECT, "sample_no", "prediction_time", "label", "n_events", "split"
    )


def sample_headers_orders(spark, d):
    return _order_headers(spark, d).select(
        "sample_id", SUBJECT, "sample_no", "prediction_time", "label", "copies", "first_time", "n_events"
    )


def sample_manifest(spark, d):
    return _assigned(spark, d).select("sample_id", "n_events", "split", "shard")


def sample_positions(spark, d):
    return samples.sample_positions(_clean(spark, d), _numbered(spark, d), _labels(spark, d)).select(
        "sample_id", SEQ, "pos", "minute"
    )


def sample_positions_orders(spark, d):
    placed, asked = _placed_orders(spark, d), _order_labels(spark, d)
    return samples.sample_positions(placed, labels.number_samples(placed, asked), asked).select("sample_id", SEQ, "copy_no", "pos", "minute")


def sample_sequences(spark, d):
    positions = samples.sample_positions(_clean(spark, d), _numbered(spark, d), _labels(spark, d))
    return samples.sample_sequences(positions, 32).select(
        "sample_id", "part", _joined("minutes").alias("minutes"), _joined("event_keys").alias("event_keys")
    )


def sample_tail(spark, d):
    return samples.sample_tail(_clean(spark, d), _headers(spark, d), _labels(spark, d), TAIL)


def sample_tail_orders(spark, d):
    placed, asked = _placed_orders(spark, d), _order_labels(spark, d)
    return samples.sample_tail(placed, labels.sample_headers(placed, asked), asked, TAIL)


# Events and labels

def event_clean(spark, d):
    return _clean(spark, d)


def event_nulled(spark, d):
    return events.null_birth_time(ad.stream_events(spark, d), ad.STREAM_BIRTH).select(SEQ, TIME)


def event_groups(spark, d):
    grouped = events.event_groups(ad.order_events(spark, d), 10)
    return grouped.select(
        SUBJECT, TIME, "part", "group_size", _joined("codes").alias("codes"), _joined("times").alias("times")
    )


def event_numbers(spark, d):
    return events.number_events(_clean(spark, d)).select(SEQ, "group_start", "group_size", "event_no")


def group_offsets(spark, d):
    return events.group_offsets(ad.order_events(spark, d))


def prefix_groups(spark, d):
    return events.prefix_groups(ad.order_events(spark, d), _order_labels(spark, d))


def subjects_semi(spark, d):
    chosen = ad.stream_labels(spark, d).where("boolean_value").select(SUBJECT)
    return events.keep_subjects(_clean(spark, d), chosen).select(SUBJECT, SEQ, CODE)


def subject_counts(spark, d):
    return ad.order_events(spark, d).agg(
        F.countDistinct(SUBJECT).alias("subjects"), F.count(F.lit(1)).alias("n_rows")
    )


def label_clean(spark, d):
    return _order_labels(spark, d)


def label_clean_dedupe(spark, d):
    return labels.clean_labels(ad.order_labels(spark, d), dedupe=True)


def label_aligned(spark, d):
    """Labels of the stream against its events; every seventh label lies in another split than its subject."""
    placed = splits.add_split(ad.stream_labels(spark, d))
    foreign = F.when(F.col("split") == "train", "tuning").otherwise("train")
    placed = placed.withColumn("split", F.when(F.col("event_id") % 7 == 0, foreign).otherwise(F.col("split")))
    return labels.align_labels(splits.add_split(_clean(spark, d)), placed)


def subject_label_lists(spark, d):
    return labels.subject_label_lists(_order_labels(spark, d), 8).select(
        SUBJECT, "part", _times("cohort_end").alias("cohort_end"), _joined("cohort_label").alias("cohort_label")
    )


def parallel_explode(spark, d):
    return labels.explode_label_lists(labels.subject_label_lists(_order_labels(spark, d)))


# Extraction

def extract_events(spark, d):
    config = {
        "events": {
            "subject_id_col": "user_id",
            "stream": {"code": "col(event_type)", "time": "col(ts)", "numeric_value": "col(value)", "note": "col(props)"},
        },
        "orders": {
            "subject_id_col": "o_custkey",
            "placed": {"code": ["ORDER", "col(o_orderpriority)"], "time": "col(o_orderdate)", "numeric_value": "col(o_totalprice)"},
            "status": {"code": ["STATUS", "col(o_orderstatus)"], "time": "col(o_orderdate)"},
        },
        "customer": {
            "subject_id_col": "c_custkey",
            "segment": {"code": ["SEGMENT", "col(c_mktsegment)"], "time": None},
        },
    }
    sources = {name: ad.table(spark, d, name) for name in config}
    return extract.extract_events(sources, config, T.DoubleType())


def merge_cohort(spark, d):
    one = extract.finalize_events(ad.stream_events(spark, d).drop(SEQ))
    again = one.where(f"{CODE} = 'click'").drop("props")
    other = extract.finalize_events(ad.order_events(spark, d).drop(SEQ))
    parts = [one, again.withColumn("props", F.lit(None).cast("string")), other]
    n_ranges = extract.range_count(extract.union_all(parts))
    merged = extract.merge_cohort(parts, N_SHARDS, n_ranges)
    group = ["split", "shard", CODE]
    # Subjects of a code are counted in as many tasks as the merge has ranges, whatever the session's number is.
    placed = merged.select(*group, SUBJECT).repartition(*([n_ranges] if n_ranges > 1 else []), *group, SUBJECT)
    pairs = placed.groupBy(*group, SUBJECT).agg(F.count(F.lit(1)).alias("n_rows"))
    return pairs.groupBy(*group).agg(F.sum("n_rows").alias("n_rows"), F.count(SUBJECT).alias("subjects"))


def finalize_events(spark, d):
    raw = ad.stream_events(spark, d).select(SUBJECT, CODE, TIME, VALUE, "props", SEQ)
    return extract.finalize_events(raw).select(
        SUBJECT, TIME, CODE, F.col(VALUE).cast("double").alias(VALUE), SEQ
    )


def union_diagonal(spark, d):
    left = ad.stream_events(spark, d).select(SUBJECT, CODE, "props")
    right = ad.order_events(spark, d).select(SUBJECT, CODE, VALUE)
    return extract.union_all([left, right])


def code_table(spark, d):
    return codes.code_table(ad.order_events(spark, d))


def code_metadata(spark, d):
    return extract.code_metadata(ad.stream_events(spark, d), [ad.stream_codes(spark)]).select(
        CODE, "description"
    )


def subject_splits(spark, d):
    return splits.subject_splits(ad.order_events(spark, d))


def subject_shards(spark, d):
    return splits.subject_shards(ad.order_events(spark, d), N_SHARDS)


def split_sizes(spark, d):
    return splits.split_sizes(splits.subject_splits(ad.order_events(spark, d)))


def split_preview(spark, d):
    return splits.split_preview(splits.subject_splits(ad.order_events(spark, d)))


def split_filter(spark, d):
    return splits.add_split(ad.order_events(spark, d)).where("split = 'tuning'").select(SUBJECT, SEQ, "split")


# Codes

def code_describe(spark, d):
    found = codes.resolve_codes(codes.code_table(ad.stream_events(spark, d)), ad.stream_codes(spark))
    return codes.describe_events(ad.stream_events(spark, d), found).select(SEQ, "code_text", "resolution")


def _order_codes(spark, d, with_items=True):
    used = codes.code_table(ad.order_events(spark, d))
    if not with_items:
        return codes.resolve_codes(used)
    return codes.resolve_codes(
        used, ad.stream_codes(spark), ad.part_items(spark, d), ad.supplier_items(spark, d)
    )


def code_fallback(spark, d):
    return _order_codes(spark, d)


def code_unresolved(spark, d):
    return codes.unresolved_codes(
        ad.order_events(spark, d), ad.stream_codes(spark), ad.part_items(spark, d), ad.supplier_items(spark, d)
    )


def code_unresolved_bare(spark, d):
    return codes.unresolved_codes(ad.order_events(spark, d))


# Text

def _described(spark, d):
    found = codes.resolve_codes(codes.code_table(ad.stream_events(spark, d)), ad.stream_codes(spark))
    found = found.withColumn("code_words", words_of(F.col("code_text")))
    return codes.describe_events(_clean(spark, d), found)


def event_text(spark, d):
    return render.render_events(_described(spark, d)).select(SEQ, "event_text")


def _line_texts(spark, d):
    """A text per line item with numbers of many shapes in it."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    text = F.concat(
        F.lit("qty "),
        (cents % 1000).cast("string"),
        F.lit("."),
        (cents * 37 % 1000003).cast("string"),
        F.lit(" v"),
        F.col("l_linenumber").cast("string"),
        F.lit("."),
        (cents % 97).cast("string"),
        F.lit("."),
        (cents % 89).cast("string"),
        F.lit(" at ."),
        (cents % 99991).cast("string"),
        F.lit("... no "),
        F.col("l_suppkey").cast("string"),
    )
    return ad.table(spark, d, "lineitem").select(
        ad.line_seq().alias(SEQ), text.alias("raw"), "l_extendedprice", "l_discount", "l_tax", "l_linenumber"
    )


def text_rounded(spark, d):
    return _line_texts(spark, d).select(SEQ, text_fn.round_decimals(F.col("raw")).alias("rounded"))


def number_text(spark, d):
    value = F.col("l_extendedprice") * F.col("l_discount") / 7 - F.col("l_tax") * 100
    scaled = (
        F.when(F.col("l_linenumber") == 6, value * F.lit(1e15))
        .when(F.col("l_linenumber") == 7, value * F.lit(1e-9))
        .otherwise(value)
    )
    return _line_texts(spark, d).select(SEQ, text_fn.float_text(scaled).alias("text"))


def digit_spaced(spark, d):
    return _line_texts(spark, d).select(SEQ, text_fn.space_digits(F.col("raw")).alias("spaced"))


def digit_runs(spark, d):
    return _line_texts(spark, d).select(SEQ, _joined(text_fn.digit_runs(F.col("raw")), "|").alias("runs"))


def place_ids(spark, d):
    return _line_texts(spark, d).select(SEQ, _joined(text_fn.text_place_ids(F.col("raw"))).alias("places"))


def document_numbers(spark, d):
    """Digit runs of whole texts: how many, and the sum of their place ids."""
    runs = text_fn.digit_runs(F.col("text"))
    places = text_fn.text_place_ids(F.col("text"))
    return ad.table(spark, d, "documents").select(
        "doc_id",
        F.size(runs).alias("n_runs"),
        F.coalesce(F.aggregate(places, F.lit(0), lambda a, x: a + x), F.lit(0)).alias("place_sum"),
    )


# Encoding

def _encoded(spark, d, length=MAX_LENGTH):
    return encode.encode_events(_described(spark, d), ad.small_vocab(spark), [SEQ], length)


def _ids_text(column: str, length: int = MAX_LENGTH) -> Column:
    """A padded list of ids as text: only its tokens are joined, the padding is zeros in all three lists."""
    padding = F.repeat(F.lit(",0"), F.lit(length) - F.col("n_tokens"))
    return F.concat(_joined(F.slice(column, 1, F.col("n_tokens"))), padding)


def encoded_events(spark, d):
    return _encoded(spark, d).select(
        SEQ,
        "n_tokens",
        _ids_text("input_ids").alias("input_ids"),
        _ids_text("type_ids").alias("type_ids"),
        _ids_text("place_ids").alias("place_ids"),
    )


def encoded_events_orders(spark, d):
    found = _order_codes(spark, d).withColumn("code_words", words_of(F.col("code_text")))
    described = codes.describe_events(ad.order_events(spark, d), found)
    return encode.encode_events(described, ad.small_vocab(spark), [SEQ], MAX_LENGTH).select(
        SEQ,
        "n_tokens",
        _ids_text("input_ids").alias("input_ids"),
        _ids_text("type_ids").alias("type_ids"),
        _ids_text("place_ids").alias("place_ids"),
    )


def encoded_documents(spark, d):
    """Whole document texts through the encoder, in numbered parts of 128 ids."""
    docs = ad.table(spark, d, "documents").select(F.col("lang").alias(CODE), "text", F.col("doc_id").alias(SEQ))
    return encode.encode_events(docs, ad.small_vocab(spark), [SEQ], 128, in_parts=True).select(
        SEQ, "part", "n_tokens", _ids_text("input_ids", 128).alias("input_ids"), _ids_text("place_ids", 128).alias("place_ids")
    )


def token_counts(spark, d):
    return _encoded(spark, d).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_rows"))


def sample_encoded(spark, d):
    rows = samples.sample_events(_clean(spark, d), _numbered(spark, d), _labels(spark, d))
    shown = _encoded(spark, d).select(SEQ, _joined("input_ids").alias("input_ids"))
    return samples.attach_encoded(rows, shown).select("sample_id", SEQ, "minute", "input_ids")


def _laid_out(headers: DataFrame, blocks: DataFrame) -> DataFrame:
    """Samples from blocks of 64 events. The ids of an event become text before samples share it, not once per sample."""
    text = lambda ids: F.array_join(F.transform(ids, lambda x: F.array_join(x.cast("array<string>"), ",")), "|")
    shown = blocks.withColumn("events", F.transform("events", lambda e: e.withField("ids", text(e["ids"]))))
    found = store.expand_samples(headers, shown, 64)
    return found.select("sample_id", "part", "n_events", F.array_join("hi", ";").alias("hi"), _joined("time").alias("time"))


def sample_nested(spark, d):
    """The stored form of the samples: per event its three id lists, and the minutes, in parts of 64 events."""
    blocks = store.event_blocks(_clean(spark, d), _encoded(spark, d), 64)
    return _laid_out(staged(_headers(spark, d), "headers"), blocks)


def sample_store(spark, d):
    """``sample_nested`` by way of the stored form: headers, and blocks of events by subject."""
    path = f"{staging_root(spark)}/event-blocks-{uuid.uuid4().hex}"
    n_buckets = max(8, -(-_clean(spark, d).count() // EVENTS_PER_BUCKET))
    write_event_blocks(store.event_blocks(_clean(spark, d), _encoded(spark, d), 64), path, n_buckets)
    return _laid_out(staged(_headers(spark, d), "headers"), read_event_blocks(spark, path))


# Result values

def _counts(spark, d):
    return profile.value_counts(ad.result_values(spark, d), "raw")


def _meta_counts(spark, d):
    return profile.value_counts(ad.result_values(spark, d), "raw", "meta")


def value_top50(spark, d):
    return profile.top_values(_counts(spark, d), "raw")


def value_top_words(spark, d):
    """The most frequent words of all document texts, of which there are the more, the more texts there are."""
    words = ad.table(spark, d, "documents").select(F.explode(F.split(F.lower("text"), r"[\x20\x09-\x0d]+")).alias("word"))
    return profile.top_frequent(words.where("word <> ''"), "word")


def value_classes(spark, d):
    return profile.classify(_counts(spark, d), category(F.col("raw")), "category")


def value_summary(spark, d):
    return profile.class_summary(value_classes(spark, d), "category", "raw", "raw")


def value_examples(spark, d):
    found = profile.class_examples(value_classes(spark, d), "category", "raw")
    return found.select("category", F.col("raw").alias("example"), "rank")


def value_buckets(spark, d):
    return profile.classify(_meta_counts(spark, d), bucket(F.col("raw")), "bucket")


def value_bucket_summary(spark, d):
    return profile.class_summary(value_buckets(spark, d), "bucket", "raw", "raw", "meta")


def value_bucket_examples(spark, d):
    found = profile.class_examples(value_buckets(spark, d), "bucket", "raw", "meta")
    return found.select("bucket", F.col("raw").alias("example"), "rank")


def value_bucket_top50(spark, d):
    top = profile.top_values(_counts(spark, d), "raw")
    return top.select(F.col("raw").alias("raw_value_exact"), bucket(F.col("raw")).alias("bucket"), "count")


# Shards and audits

def _split_headers(spark, d):
    return splits.add_split(_headers(spark, d))


def _assigned(spark, d):
    return shards.assign_shards(_split_headers(spark, d), SHARD_BUDGET)


def shard_assign(spark, d):
    return _assigned(spark, d).drop("shard_offset")


def shard_running(spark, d):
    """Where the events of each sample lie in its shard."""
    return _assigned(spark, d).select(
        "split", "shard", "sample_id", "n_events", "shard_offset", (F.col("shard_offset") + F.col("n_events")).alias("running_events")
    )


def shard_balance(spark, d):
    return shards.shard_balance(_assigned(spark, d), SHARD_BUDGET)


def audit_rows(spark, d):
    counted = [
        audit.rows_per_file(ad.table(spark, d, name))
        for name in ("events", "orders", "lineitem", "customer", "part", "supplier")
    ]
    name = F.regexp_extract("file", r"([^/]+)\.parquet$", 1)
    return extract.union_all(counted).select(name.alias("file"), "n_rows")


def file_rows(spark, d):
    """Rows per kind of file and folder of stored orders: Parquet by status, one status that no order has, and CSV."""
    root = f"{staging_root(spark)}/file-rows-{uuid.uuid4().hex}"
    orders = ad.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    for status in ("F", "O", "P", "none"):
        orders.where(F.col("o_orderstatus") == status).write.parquet(f"{root}/{status}")
    orders.select("o_orderkey", "o_orderpriority").write.option("header", True).csv(f"{root}/lines")
    found = audit.file_rows(spark, root)
    folder = F.regexp_extract("file", r"([^/]+)/[^/]+$", 1).alias("folder")
    return found.groupBy(folder, "format").agg(F.sum("n_rows").alias("n_rows"), F.min("readable").alias("readable"))


def audit_units(spark, d):
    scalar = audit.work_units(ad.stream_events(spark, d)).select(F.lit("scalar").alias("layout"), "n")
    grouped = events.event_groups(ad.order_events(spark, d)).select(F.col("codes").alias(CODE))
    return scalar.unionByName(audit.work_units(grouped).select(F.lit("list").alias("layout"), "n"))


def audit_output(spark, d):
    manifest = _assigned(spark, d).select("sample_id", "split", "shard", "n_events")
    placed = _numbered(spark, d).join(manifest.select("sample_id", "split", "shard"), "sample_id")
    rows = samples.sample_events(_clean(spark, d), placed, _labels(spark, d), carry=["split", "shard"])
    stored = staged(rows, "audited")
    return audit.audit_output(stored, manifest)


def audit_splits(spark, d):
    return audit.splits_with_output(audit_output(spark, d))


def file_preview_rows(spark, d):
    names = {"events": "event_id", "orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey"}
    parts = [
        file_preview(ad.table(spark, d, name)).select(
            F.regexp_replace("file", r"\.parquet$", "").alias("file"), "row_no", F.col(key).alias("key")
        )
        for name, key in names.items()
    ]
    return extract.union_all(parts)


def output_names(spark, d):
    files = ad.table(spark, d, "events").select(F.col("_metadata.file_path").alias("file"))
    return files.groupBy(split_from_path(d, F.col("file")).alias("name")).agg(F.count(F.lit(1)).alias("n_rows"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        sample_events, sample_events_orders, sample_headers, sample_headers_orders, sample_manifest,
        sample_positions, sample_positions_orders, sample_sequences, sample_tail, sample_tail_orders,
        event_clean, event_nulled, event_groups, event_numbers, group_offsets, prefix_groups,
        subjects_semi, subject_counts, label_clean, label_clean_dedupe, label_aligned, subject_label_lists, parallel_explode,
        extract_events, merge_cohort, finalize_events, union_diagonal, code_table, code_metadata,
        subject_splits, subject_shards, split_sizes, split_preview, split_filter,
        code_describe, code_fallback, code_unresolved, code_unresolved_bare,
        event_text, text_rounded, number_text, digit_spaced, digit_runs, place_ids, document_numbers,
        encoded_events, encoded_events_orders, encoded_documents, token_counts, sample_encoded, sample_nested, sample_store,
        value_top50, value_top_words, value_classes, value_summary, value_examples, value_buckets, value_bucket_summary,
        value_bucket_examples, value_bucket_top50,
        shard_assign, shard_running, shard_balance, audit_rows, file_rows, audit_units, audit_output, audit_splits,
        file_preview_rows, output_names,
    )
}
