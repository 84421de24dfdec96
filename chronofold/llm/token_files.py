"""Token ids in files: frequency ranks in byte-aligned variable-length code, control bytes apart.

A file holds blocks. A block is a header (magic, documents, ids, bytes of data), the index of its
documents (a flag for a null id, doc_id, ids), the control bytes (two bits per id: bytes used less
one, four ids a byte, lowest bits first) and the data bytes, lowest first. An id is stored as its rank by
frequency, so that the 256 most frequent ids take one byte; the ranks stand beside the files in
``ranks``. Spark's text writer writes the blocks as they are, so files appear on any file system
Spark can write, and only when their task has succeeded.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronofold.llm.batches import bounded_batches, frugal, valid_text
from chronofold.llm.tokens import encoder, vocabulary_size
from chronofold.sources.staging import staged

END_ID = 2
IDS_PER_FILE = 4_000_000
IDS_PER_BLOCK = 500_000
MAGIC = b"CFT1"
HEADER = struct.Struct("<4sqqq")
_CODES = np.array([[(c >> (2 * k)) & 3 for k in range(4)] for c in range(256)], np.uint8)
_STEPS = np.arange(4, dtype=np.uint8)


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    ranks = ranks.astype("<u4")
    codes = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    data = ranks.view(np.uint8).reshape(-1, 4)[_STEPS <= codes[:, None]]
    quads = np.zeros(-(-len(codes) // 4) * 4, np.uint8)
    quads[: len(codes)] = codes
    quads = quads.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """Inverse of ``pack_ranks``: code lengths by a table of 256 control bytes."""
    codes = _CODES[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    out = np.zeros((n, 4), np.uint8)
    out[_STEPS <= codes[:, None]] = np.frombuffer(data, np.uint8)
    return out.view("<u4").reshape(-1)


def write_block(docs: list[tuple[int | None, np.ndarray]]) -> bytes:
    """One block from (doc_id, ranks) pairs."""
    counts = np.array([len(r) for _, r in docs], "<i8")
    flags = np.array([d is None for d, _ in docs], np.uint8)
    names = np.array([d or 0 for d, _ in docs], "<i8")
    control, data = pack_ranks(np.concatenate([r for _, r in docs]))
    return b"".join([
        HEADER.pack(MAGIC, len(docs), int(counts.sum()), len(data)),
        flags.tobytes(), names.tobytes(), counts.tobytes(), control, data,
    ])


def read_blocks(content: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    """The (doc_id, ranks) pairs of a file, in its order."""
    at = 0
    while at < len(content):
        magic, n_docs, n_ids, n_data = HEADER.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError(f"no block at byte {at}")
        at += HEADER.size
        flags = np.frombuffer(content, np.uint8, n_docs, at)
        names = np.frombuffer(content, "<i8", n_docs, at + n_docs)
        counts = np.frombuffer(content, "<i8", n_docs, at + 9 * n_docs)
        at += 17 * n_docs
        n_control = -(-n_ids // 4)
        ranks = unpack_ranks(content[at : at + n_control], content[at + n_control : at + n_control + n_data], n_ids)
        at += n_control + n_data + 1  # the writer's line end
        ends = np.cumsum(counts)
        for null, name, end, n in zip(flags.tolist(), names.tolist(), ends.tolist(), counts.tolist(), strict=True):
            yield (None if null else name), ranks[end - n : end]


def id_kind(tokenizer: str, end_id: int) -> str:
    """The narrowest of two widths that holds all ids."""
    return "<u2" if max(vocabulary_size(tokenizer), end_id + 1) <= 1 << 16 else "<u4"


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int = END_ID, kind: str = "<u4") -> DataFrame:
    """doc_id, n_tokens and the ids (as ``kind``) of every whole text, the end id last; and per task a row with ``counts`` alone, how often each id occurs.

    Bytes of a text that are no UTF-8 stand as U+FFFD.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(tokenizer, kind=kind)
        tail = np.array([end_id], kind).tobytes()
        counts = np.zeros(max(encoding.size, end_id + 1), np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                ids = [x + tail for x in encoding.encode([t or "" for t in part.column(1).to_pylist()])]
                counts += np.bincount(np.frombuffer(b"".join(ids), kind), minlength=len(counts))
                sizes = pa.array([len(x) // len(tail) for x in ids], pa.int64())
                columns = [part.column(0), sizes, pa.array(ids, pa.binary()), pa.nulls(len(ids), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)
        nothing = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary())]
        yield pa.RecordBatch.from_arrays([*nothing, pa.array([counts.tobytes()], pa.binary())], names)

    names = ["doc_id", "n_tokens", "ids", "counts"]
    bounded_batches(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), valid_text().alias("text"))
    return narrow.mapInArrow(frugal(run), "doc_id bigint, n_tokens bigint, ids binary, counts binary")


def id_counts(encoded: DataFrame) -> DataFrame:
    """How often each id occurs, from the counts of the tasks; no id is read again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for stored in batch.column(0).to_pylist():
                found = np.frombuffer(stored, np.int64)
                total = found.copy() if not len(total) else total + found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])

    bounded_batches(encoded.sparkSession)
    parts = encoded.select("counts").where("counts is not null").mapInArrow(frugal(run), "id bigint, n bigint")
    return parts.groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, ids_per_file: int = IDS_PER_FILE
) -> None:
    """Write the ids of all documents to ``folder``/files in ascending doc_id order (nulls first).

    Rows with equal doc_id follow each other by length, then by a hash of their ids, and may lie in several files. A null text counts as empty. An empty
    table gives an empty folder. The rank table has at most as many rows as the vocabulary.
    """
    spark, kind = docs.sparkSession, id_kind(tokenizer, end_id)
    encoded = staged(encode_documents(docs, tokenizer, end_id, kind), "encoded", "zstd")
    by_count = id_counts(encoded).orderBy(F.desc("n"), "id").collect()  # at most the vocabulary
    ids = np.array([r["id"] for r in by_count], np.int64)
    total = sum(r["n"] for r in by_count)
    spark.createDataFrame([(k, int(i)) for k, i in enumerate(ids)], "rank bigint, id bigint").write.parquet(f"{folder}/ranks")
    rank_of = np.zeros(int(ids.max(initial=0)) + 1, np.uint32)
    rank_of[ids] = np.arange(len(ids), dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, np.ndarray]] = []
        n = 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([write_block(held)], pa.binary())], ["block"])

        for batch in batches:
            stored = batch.column(1).to_pylist()
            ranks = rank_of[np.frombuffer(b"".join(stored), kind)]
            ends = np.cumsum([len(x) for x in stored]) // np.dtype(kind).itemsize
            for doc, ids in zip(batch.column(0).to_pylist(), np.split(ranks, ends[:-1]), strict=True):
                held.append((doc, ids))
                n += len(ids)
                if n >= IDS_PER_BLOCK:
                    yield block()
                    held, n = [], 0
        if held:
            yield block()

    parts = max(1, -(-total // ids_per_file))
    blocks = (
        encoded.where("ids is not null")
        .withColumn("_hash", F.xxhash64("ids"))
        .repartitionByRange(parts, "doc_id", "n_tokens", "_hash")
        .sortWithinPartitions("doc_id", "n_tokens", "_hash")
        .select("doc_id", "ids")
        .mapInArrow(frugal(run), "block binary")
    )
    blocks.select(F.col("block").cast("string").alias("value")).write.text(f"{folder}/files")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    A file of at most ``ids_per_file`` ids (or one document, if that is longer) is read at a time.
    """
    table = spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()  # at most the vocabulary
    id_of = np.array([r["id"] for r in table], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                found = [(d, len(r), zlib.crc32(id_of[r].tobytes())) for d, r in read_blocks(content.as_py())]
                sizes = np.array([n for _, n, _ in found], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path.as_py()] * len(found), pa.string()),
                        pa.array([d for d, _, _ in found], pa.int64()),
                        pa.array(np.cumsum(sizes) - sizes, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([c for _, _, c in found], pa.int64()),
                    ],
                    ["path", "doc_id", "local", "n_tokens", "ids_crc32"],
                )

    bounded_batches(spark)
    files = spark.read.format("binaryFile").load(f"{folder}/files").where("length > 0").select("path", "content")
    rows = staged(files.mapInArrow(frugal(run), "path string, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint"), "read")
    # One row per file, whose names sort in the order of the ranges.
    before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("path").agg(F.sum("n_tokens").alias("n")).select(
        "path", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    return rows.join(starts, "path").select(
        "doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )
