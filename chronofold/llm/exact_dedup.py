"""Exact duplicates by two passes over a Bloom filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.sources.staging import staged

WHITE = r"[\x20\x09-\x0D]+"
BITS_PER_ROW = 16
MAX_BITS = 2**30  # the broadcast filter holds at most 128 MB
HASHES = 2


def digest(text: Column) -> Column:
    """SHA-256 of the text without white space; null counts as empty."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, "").cast("binary"), 256))


def filter_bits(rows: int) -> int:
    """Bits of the filter: a power of two, 16 or more a row up to ``MAX_BITS``.

    Beyond that more rows look repeated and shuffle; the result is the same.
    """
    bits = 1 << 15
    while bits < min(rows * BITS_PER_ROW, MAX_BITS):
        bits *= 2
    return bits


def _slot(key: str, k: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(k)), F.lit(bits))


def repeated_slots(rows: DataFrame, key: str, bits: int) -> DataFrame:
    """First pass: the slots of the filter that more than one row hits, as bitmaps of 4 KB.

    Slots are counted with map-side combine; only pairs of 8-byte numbers shuffle.
    """
    slots = F.explode(F.array(*[_slot(key, k, bits) for k in range(HASHES)])).alias("slot")
    hit_again = rows.select(slots).groupBy("slot").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return hit_again.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )


def flag_repeated(rows: DataFrame, key: str, slots: DataFrame, bits: int) -> DataFrame:
    """Second pass: ``maybe`` is true where all slots of a row were hit again. The bitmaps are broadcast,
    at most ``bits`` / 8 bytes of them."""
    maybe = F.lit(True)
    for k in range(HASHES):
        slot = _slot(key, k, bits)
        rows = rows.join(
            F.broadcast(slots.withColumnsRenamed({"bucket": f"_bucket{k}", "bits": f"_bits{k}"})),
            F.bitmap_bucket_number(slot) == F.col(f"_bucket{k}"),
            "left",
        )
        at = F.bitmap_bit_position(slot)
        byte = F.conv(F.hex(F.col(f"_bits{k}").substr((F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        is_set = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(at, F.lit(8)))), F.lit(2)) == 1
        maybe = maybe & F.coalesce(is_set, F.lit(False))
    return rows.withColumn("maybe", maybe).drop(*[f"_{n}{k}" for n in ("bucket", "bits") for k in range(HASHES)])


def _better() -> Column:
    """The row that stays: most code points in the original text, then smallest doc_id, a null id last."""
    return F.struct("n_points", F.col("doc_id").isNotNull().alias("named"), F.bitwise_not("doc_id").alias("turned"))


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are so without white space; null counts as empty, so null, empty and blank
    texts form one group. Of a group the row with the most code points stays, then the smallest doc_id; null
    ids come last. Repeated ids with equal text and length are one document: all of them say kept. Other
    columns are not read. An empty table gives an empty result.

    Only rows whose hash looks repeated are grouped; their groups shrink to one row before they shuffle.
    The others pass straight through. The join back to the groups is on plain exchanges on both sides, so
    adaptive execution splits the partition of a large group.
    """
    rows = staged(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.coalesce(F.length("text"), F.lit(0)).alias("n_points"),
            digest(F.col("text")).alias("digest"),
        ),
        "digests",
    )
    bits = filter_bits(rows.count())
    flagged = flag_repeated(rows, "digest", staged(repeated_slots(rows, "digest", bits), "slots"), bits)
    out = [F.col("keep_id"), F.col("group_size"), F.col("kept"), F.lower(F.hex("digest")).alias("text_sha256")]
    alone = (
        flagged.where(~F.col("maybe"))
        .withColumns({"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("bigint"), "kept": F.lit(True)})
        .select("doc_id", *out)
    )
    again = flagged.where("maybe")
    groups = staged(
        again.groupBy("digest").agg(
            F.max(_better()).alias("best"), F.count(F.lit(1)).alias("group_size")
        ).select("digest", "group_size", F.bitwise_not("best.turned").alias("keep_id"), F.col("best.n_points").alias("best_points")),
        "groups",
    )
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("best_points"))
    grouped = again.join(groups, "digest").withColumn("kept", kept).select("doc_id", *out)
    return alone.unionByName(grouped)


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """Whole rows of ``docs``, one of each group of equal texts (as in ``duplicate_groups``, but of rows equal
    in id and length too just one stays). Rows that the filter knows to be alone do not shuffle."""
    columns = docs.columns
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.coalesce(F.length("text"), F.lit(0)).alias("n_points"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        digest(F.col("text")).alias("digest"),
    )
    narrow = staged(keyed.select("digest"), "digests")
    bits = filter_bits(narrow.count())
    flagged = flag_repeated(keyed, "digest", staged(repeated_slots(narrow, "digest", bits), "slots"), bits)
    alone = flagged.where(~F.col("maybe")).select("row")
    best = flagged.where("maybe").groupBy("digest").agg(F.max_by("row", _better()).alias("row")).select("row")
    return alone.unionByName(best).select("row.*")
