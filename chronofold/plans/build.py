"""Events and labels to encoded, numbered samples on disk, with a manifest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.functions.wordpiece import words_of
from chronofold.operators import audit, codes, encode, events as ev, labels as lb, samples, shards, splits, store
from chronofold.operators.skew import lookup_join
from chronofold.schema import (
    BIRTH_CODE,
    CODE,
    EVENTS_PER_SHARD,
    LABEL_COLUMN,
    MAX_EVENT_LENGTH,
    SEQ,
    SUBJECT,
    TIME,
    require,
)
from chronofold.sources.staging import clears_staging, staged
from chronofold.sources.writers import (
    is_complete,
    read_event_blocks,
    write_event_blocks,
    write_manifest,
    write_mode,
    write_samples,
    write_table,
)

EVENTS_PER_BUCKET = 500_000
# Forms in which every sample holds all its events, which grow with events times labels.
EXPANDED = ("sample_events", "nested_samples")


@dataclass
class SampleTables:
    """Where the parts of a sample set are stored below its root."""

    root: str

    @property
    def samples(self) -> str:
        return f"{self.root}/samples"

    @property
    def event_blocks(self) -> str:
        return f"{self.root}/event_blocks"

    @property
    def sample_events(self) -> str:
        return f"{self.root}/sample_events"

    @property
    def nested_samples(self) -> str:
        return f"{self.root}/nested_samples"

    @property
    def encoded_events(self) -> str:
        return f"{self.root}/encoded_events"

    @property
    def manifest(self) -> str:
        return f"{self.root}/manifest"

    @property
    def unresolved_codes(self) -> str:
        return f"{self.root}/unresolved_codes"


@clears_staging
def build_samples(
    events: DataFrame,
    labels: DataFrame,
    vocab: DataFrame,
    root: str,
    codes_metadata: DataFrame | None = None,
    items: DataFrame | None = None,
    lab_items: DataFrame | None = None,
    birth_code: str = BIRTH_CODE,
    label_column: str = LABEL_COLUMN,
    max_length: int = MAX_EVENT_LENGTH,
    lowercase: bool = False,
    events_per_shard: int = EVENTS_PER_SHARD,
    if_exists: str = "error",
    expanded: tuple[str, ...] = (),
) -> SampleTables:
    """Write samples, event blocks, manifest and unresolved codes below ``root``, and what ``expanded`` asks for.

    Samples are headers and share the encoded events of their subject, which are stored once, in blocks; ``read_samples`` lays them out.
    ``expanded`` may name ``sample_events`` (a row per sample and event, with encoded events beside it) and ``nested_samples`` (lists per sample).

    ``events`` carries ``seq`` and, optionally, ``split``; without it subjects are split by hash.
    The input is read once, to write the cleaned events that all steps read; so ``seq`` is one number per event
    however the input is split. Every step that others read is written first, so nothing is computed twice and a
    lost executor costs only its own tasks.
    """
    out = SampleTables(root)
    if unknown := set(expanded) - set(EXPANDED):
        raise ValueError(f"expanded may hold {EXPANDED}, not {sorted(unknown)}")
    spark = events.sparkSession
    mode = write_mode(if_exists)
    if mode == "ignore" and is_complete(spark, out.manifest):
        return out
    # An interrupted run left an incomplete output: write it again.
    each = "rebase" if if_exists == "skip" else if_exists

    require(events, SUBJECT, TIME, CODE, SEQ)
    given_split = "split" in events.columns
    clean = staged(ev.clean_events(events, birth_code), "clean")
    if "split" in labels.columns and not given_split:
        labels = labels.drop("split")
    if "split" in labels.columns:
        labels = lb.align_labels(clean, labels)
    slim = clean.select(SUBJECT, TIME, SEQ)
    wanted = staged(lb.clean_labels(labels, label_column), "labels")

    numbered = lb.sample_headers(slim, wanted)
    if given_split:
        numbered = lookup_join(numbered, subject_split(clean), SUBJECT)
    else:
        numbered = splits.add_split(numbered)
    headers = staged(numbered, "headers")
    assigned = shards.assign_shards(headers, events_per_shard)
    stored = headers.join(assigned.select("sample_id", "shard"), "sample_id")
    write_table(stored, out.samples, ["split"], each)

    used = codes.code_table(clean)
    resolved = staged(codes.resolve_codes(used, codes_metadata, items, lab_items), "codes")
    write_table(
        used.join(resolved.where("resolution = 'none'").select(CODE), CODE), out.unresolved_codes, None, each
    )
    described = codes.describe_events(
        clean.drop("split"), resolved.withColumn("code_words", words_of(F.col("code_text")))
    )
    encoded = staged(encode.encode_events(described, vocab, [SEQ], max_length, lowercase), "encoded")
    n_buckets = -(-max(1, encoded.count()) // EVENTS_PER_BUCKET)
    write_event_blocks(store.event_blocks(slim, encoded), out.event_blocks, n_buckets, each)

    if "sample_events" in expanded:
        ready = spark.read.parquet(out.samples).withColumn(
            "n_slices", F.ceil(F.col("n_events") / events_per_shard).cast("int")
        )
        rows = samples.sample_events(slim, ready, wanted, carry=["split", "shard", "n_slices"])
        write_samples(rows, out.sample_events, each)
        write_table(encoded, out.encoded_events, None, each)
    if "nested_samples" in expanded:
        named = spark.read.parquet(out.samples).select("sample_id", SUBJECT, "label", "split", "shard")
        write_table(read_samples(spark, out).join(named, "sample_id"), out.nested_samples, ["split"], each)

    # Last, so that its success mark stands for the whole output.
    write_manifest(
        spark.read.parquet(out.samples).select("sample_id", "n_events", "split", "shard"), out.manifest, f"{out.samples}/split=", each
    )
    return out


def subject_split(events: DataFrame) -> DataFrame:
    """Each subject once with its split."""
    return events.groupBy(SUBJECT).agg(F.min("split").alias("split"))


def read_samples(spark: SparkSession, out: SampleTables, chosen: DataFrame | None = None) -> DataFrame:
    """Stored samples laid out: sample_id, part, hi, time, n_events; of all, or of the rows of ``samples`` that were ``chosen``."""
    headers = spark.read.parquet(out.samples) if chosen is None else chosen
    return store.expand_samples(headers, read_event_blocks(spark, out.event_blocks))


def check_samples(spark: SparkSession, out: SampleTables) -> DataFrame:
    """Stored events of the samples against the sample table, per split and shard."""
    headers = spark.read.parquet(out.samples)
    found = store.stored_counts(headers, read_event_blocks(spark, out.event_blocks))
    return audit.audit_counts(found, headers)
