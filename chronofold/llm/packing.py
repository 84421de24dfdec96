"""Hierarchical packing of token ids into windows of several lengths."""

from __future__ import annotations

import heapq
import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm.batches import bounded_batches, frugal, valid_text
from chronofold.llm.tokens import MAX_CACHED, encoder

TIERS = (4096, 2048, 1024, 512)
END_ID = 2
GROUP_TOKENS = 16 * 4096
BUFFER_GROUPS = 4
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
    " sequence_id bigint, offset bigint, tier int, step_group bigint"
)

Doc = tuple[int | None, bytes]
Piece = tuple[int, int, int, Doc]  # length, tie-break, start, document


class Packer:
    """Packs one stream of documents; at most a few step groups of ids wait at a time.

    A document goes to the shortest tier that holds it; of a longer one the whole windows of the longest
    tier are cut off first. Tiers are packed from long to short: a window starts with the longest
    waiting piece of its tier, then takes the longest whole pieces of shorter tiers that fit, and the last gap is
    closed by cutting a piece. At the end of the stream the rest is laid out in windows of falling powers
    of two, so that no window is padded.
    """

    def __init__(self, tiers: tuple[int, ...] = TIERS, group_tokens: int = GROUP_TOKENS) -> None:
        if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(tiers, reverse=True):
            raise ValueError("tiers are falling powers of two")
        self._tiers = tiers
        self._group_tokens = group_tokens
        self._waiting: list[Piece] = []  # by length
        self._tokens = 0
        self._next = 0
        self._sequences = 0
        self._groups = 0
        self._ready: list[tuple[int, list[Piece]]] = []
        self._ready_tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> list[tuple]:
        doc, n, start = (doc_id, ids), len(ids) // 4, 0
        while n - start >= self._tiers[0]:
            self._take(self._tiers[0], [self._piece(self._tiers[0], start, doc)])
            start += self._tiers[0]
        if n > start:
            self._wait(self._piece(n - start, start, doc))
        if self._tokens + self._ready_tokens < BUFFER_GROUPS * self._group_tokens:
            return []
        return self._flush()

    def finish(self) -> list[tuple]:
        rows = self._flush()
        size = 1 << max(self._tokens, 1).bit_length() - 1
        while self._tokens:
            while size > self._tokens:
                size //= 2
            self._window(size)
        return rows + self._deal()

    def _piece(self, length: int, start: int, doc: Doc) -> Piece:
        self._next += 1
        return (length, self._next, start, doc)

    def _wait(self, piece: Piece) -> None:
        insort(self._waiting, piece, key=lambda p: p[:2])
        self._tokens += piece[0]

    def _flush(self) -> list[tuple]:
        while self._tokens >= self._tiers[0]:
            longest = self._waiting[-1][0]
            self._window(next(t for t in reversed(self._tiers) if t >= longest))
        return self._deal()

    def _window(self, size: int) -> None:
        """Fill one window wholly from the waiting pieces; they hold enough."""
        gap, pieces = size, []
        while gap:
            k = bisect_right(self._waiting, gap, key=lambda p: p[0])
            length, _, start, doc = piece = self._waiting.pop(k - 1 if k else 0)
            self._tokens -= length
            if length > gap:
                self._wait(self._piece(length - gap, start + gap, doc))
                piece = self._piece(gap, start, doc)
            pieces.append(piece)
            gap -= piece[0]
        self._take(size, pieces)

    def _take(self, size: int, pieces: list[Piece]) -> None:
        self._ready.append((size, pieces))
        self._ready_tokens += size

    def _deal(self) -> list[tuple]:
        """Give the windows at hand to step groups, the longest first, each to the group with the fewest tokens."""
        n = -(-self._ready_tokens // self._group_tokens)
        loads = [(0, self._groups + g) for g in range(n)]
        rows = []
        for size, pieces in sorted(self._ready, key=lambda w: -w[0]):
            load, group = loads[0]
            heapq.heapreplace(loads, (load + size, group))
            offset = 0
            for length, _, start, (doc_id, ids) in pieces:
                crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                rows.append((doc_id, start, length, crc, len(ids) // 4, self._sequences, offset, size, group))
                offset += length
            self._sequences += 1
        self._groups += n
        self._ready, self._ready_tokens = [], 0
        return rows


SPLIT_BITS, COUNT_BITS = 17, 26  # of a sequence_id by files: splits of a file, sequences of a split; the rest numbers the files


def _file_places(docs: DataFrame) -> tuple[dict[str, int], int] | None:
    """Place of each file of ``docs`` in the order of the numbers in their names, and the least length of a split.

    None if the rows do not come straight from files of distinct names.
    """
    try:
        docs.select("_metadata.file_name", "_metadata.file_block_start")
    except AnalysisException:
        return None
    names = [path.rsplit("/", 1)[-1] for path in docs.inputFiles()]
    if len(set(names)) < len(names):
        return None
    ordered = sorted(names, key=lambda n: [(int(x), "") if x.isdecimal() else (-1, x) for x in re.split(r"([0-9]+)", n)])
    if len(ordered) >> 63 - SPLIT_BITS - COUNT_BITS:
        raise ValueError("too many files to number")
    spark = docs.sparkSession
    to_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    lengths = [to_bytes(spark.conf.get(f"spark.sql.files.{c}")) for c in ("maxPartitionBytes", "openCostInBytes")]
    return {name: k for k, name in enumerate(ordered)}, max(1, min(lengths))


def _runs(batch: pa.RecordBatch, by_file: bool) -> Iterator[tuple[tuple[str, int] | None, pa.RecordBatch]]:
    """Slices of at most 256 rows, each of one file and split."""
    edges = [0, batch.num_rows]
    if by_file and batch.num_rows:
        keys = list(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True))
        edges = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
    for low, high in zip(edges, edges[1:], strict=False):
        for i in range(low, high, 256):
            yield (keys[low] if by_file else None), batch.slice(i, min(256, high - i))


def _file_base(source: tuple[str, int], places: dict[str, int], split: int) -> int:
    name, start = source
    if start // split >> SPLIT_BITS:
        raise ValueError(f"too many splits of {name} to number")
    return (places[name] << SPLIT_BITS | start // split) << COUNT_BITS


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    tiers: tuple[int, ...] = TIERS,
    end_id: int = END_ID,
    group_tokens: int = GROUP_TOKENS,
    cached_pieces: int = MAX_CACHED,
    by_file: bool = False,
) -> DataFrame:
    """One row per piece: where its ids stand in the document and in the packed sequence.

    Each task packs the documents it reads, in their order, so nothing is shuffled and a lost task is packed
    again alike. Null texts count as empty and hold the end id alone; null doc_ids stay null; repeated
    rows are packed as they come; an empty table gives no row. ``sequence_id`` and ``step_group`` carry the
    task's partition in the upper bits. Cutting is free, so no sequence is padded: its length is a power of two.

    Spark reads files by size. With ``by_file`` each file (each split of a large one) is a stream of its own and the upper bits
    number the files by their names, so that ``sequence_id`` follows the order in which the rows were written, but for the
    few step groups that wait in a stream. Rows that do not come straight from files are packed by task.
    """
    files = _file_places(docs) if by_file else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, cached_pieces).encode
        packer, base, read = Packer(tiers, group_tokens), TaskContext.get().partitionId() << 40, None
        tail = np.array([end_id], "<u4").tobytes()

        def table(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
            columns = list(zip(*rows, strict=True))
            for k in (5, 8):
                columns[k] = [base + x for x in columns[k]]
            names = [f.split()[0] for f in SCHEMA.split(",")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for source, part in _runs(batch, files is not None):
                if source != read:
                    if rows := packer.finish():
                        yield table(rows)
                    packer, base, read = Packer(tiers, group_tokens), _file_base(source, *files), source
                rows = []
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc_id, ids in zip(part.column(0).to_pylist(), encode(texts), strict=True):
                    rows += packer.add(doc_id, ids + tail)
                if rows:
                    yield table(rows)
        if rows := packer.finish():
            yield table(rows)

    bounded_batches(docs.sparkSession)
    of_file = [F.col(f"_metadata.{c}") for c in ("file_name", "file_block_start")] if files else []
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), valid_text().alias("text"), *of_file)
    return narrow.mapInArrow(frugal(run), SCHEMA)
