"""SimHash near-duplicates by exact comparison in tiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.llm.batches import bounded_batches, frugal, valid_text
from chronofold.llm.graph import Forest, components
from chronofold.sources.staging import staged

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
BLOCK = 16_384  # fingerprints of a block: 128 KB
TILE = 256


def fingerprint(text: str, width: int = SHINGLE_WORDS) -> int:
    """A bit is set if it is set in over half the XXH64 hashes of the word shingles; zero for no words."""
    import xxhash

    hash_of = xxhash.xxh64_intdigest
    words = text.encode().lower().split()  # bytes: A-Z only, and the six ASCII white-space characters
    if len(words) <= width:
        return hash_of(b" ".join(words), SEED) if words else 0
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - width + 1].tolist()
    hashes = np.array([hash_of(line[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)], "<u8")
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65_536):
        part = hashes[i : i + 65_536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and ``fp``, the fingerprint of the whole text as a signed number. Null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t or "", width) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], ["doc_id", "fp"]
            )

    bounded_batches(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), valid_text().alias("text"))
    return narrow.mapInArrow(frugal(run), "doc_id bigint, fp bigint")


def _where(near: np.ndarray, row: int, col: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the true entries of a tile that starts at ``row`` and ``col``."""
    rows, cols = np.divmod(np.flatnonzero(near), near.shape[1])
    return rows + row, cols + col


def _quarters(block: np.ndarray) -> np.ndarray:
    """Population counts of the four 16-bit quarters of each fingerprint."""
    return np.bitwise_count(block.view(np.uint16).reshape(-1, 4)).astype(np.int16)


def _sorted(block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The block by its population counts, and the least and most of each quarter in each tile."""
    counts = _quarters(block)
    order = np.lexsort(counts.T)
    block, counts = block[order], counts[order]
    tops = range(0, len(block), TILE)
    low = np.array([counts[i : i + TILE].min(0) for i in tops])
    high = np.array([counts[i : i + TILE].max(0) for i in tops])
    return block, low, high


def tile_links(a: np.ndarray, b: np.ndarray | None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links within ``a`` (``b`` None) or between ``a`` and ``b`` that connect all that lies within the radius.

    Every pair is compared, but for pairs of tiles whose population counts differ beyond the radius:
    the counts of the four quarters differ by no more, in sum, than the fingerprints themselves. A link
    between fingerprints that are connected already is left out, so the number of links stays below that of the fingerprints.
    """
    a, low_a, high_a = _sorted(a)
    same = b is None
    b, low_b, high_b = (a, low_a, high_a) if same else _sorted(b)
    shift = 0 if same else len(a)
    forest = Forest(len(a) + (0 if same else len(b)))
    for i, (low, high) in enumerate(zip(low_a, high_a, strict=True)):
        apart = np.maximum(np.maximum(low - high_b, low_b - high), 0).sum(1)
        left = a[i * TILE : (i + 1) * TILE, None]
        for j in np.flatnonzero(apart <= radius).tolist():
            if same and j < i:
                continue
            near = np.bitwise_count(left ^ b[None, j * TILE : (j + 1) * TILE]) <= radius
            if near.any():
                rows, cols = _where(near, i * TILE, j * TILE + shift)
                new = forest.parent[rows] != forest.parent[cols]
                forest.add(rows[new], cols[new])
    pairs = np.array(forest.links, np.int64).reshape(-1, 2)
    return a[pairs[:, 0]], (b[pairs[:, 1] - shift])


def _part(bin_column: str, hashed: Column, sizes: dict[int, int]) -> Column:
    """The block of a row within its bin."""
    cuts = F.create_map(*[F.lit(x) for kv in sizes.items() for x in kv])
    return F.pmod(hashed, cuts[F.col(bin_column)]).cast("int")


def _meetings(blocks: DataFrame, sizes: dict[int, int], reach: int) -> DataFrame:
    """Each block beside itself and every block of a bin up to ``reach`` further, once; columns of the second end in ``_b``.

    ``sizes`` is the number of blocks per bin. The pairs are spread over tasks, as comparing outweighs moving them.
    """
    cuts = F.create_map(*[F.lit(x) for kv in sizes.items() for x in kv])
    left = (
        blocks.withColumn("bin_b", F.explode(F.sequence("bin", F.col("bin") + reach)))
        .withColumn("part_b", F.explode(F.sequence(F.lit(0), cuts[F.col("bin_b")] - 1)))
        .where((F.col("bin_b") > F.col("bin")) | (F.col("part_b") >= F.col("part")))
    )
    right = blocks.select(*[F.col(c).alias(f"{c}_b") for c in blocks.columns])
    same = (F.col("bin") == F.col("bin_b")) & (F.col("part") == F.col("part_b"))
    pairs = sum(n * (n + 1) // 2 + n * sum(sizes.get(b + k, 0) for k in range(1, reach + 1)) for b, n in sizes.items())
    return left.join(right, ["bin_b", "part_b"]).withColumn("same", same).repartition(max(8, min(pairs, 4096)))


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints (column ``fp``) that connect all within the radius.

    Blocks hold fingerprints of one population count; a block meets the blocks whose counts differ by
    at most the radius, by an equi-join on the block's name. One table of at most 65 rows, the number of blocks
    per population count, is collected; fingerprints are not.
    """
    spark = distinct.sparkSession
    counted = distinct.select("fp", F.bit_count("fp").alias("ones"))
    sizes = {r["ones"]: -(-r["n"] // block) for r in counted.groupBy("ones").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    blocks = staged(
        counted.withColumn("part", _part("ones", F.xxhash64("fp"), sizes))
        .groupBy(F.col("ones").alias("bin"), "part")
        .agg(F.collect_list("fp").alias("fps")),
        "blocks",
    )
    work = _meetings(blocks, sizes, radius).select("same", "fps", "fps_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                same = batch.column(0)[k].as_py()
                a, b = (c[k].values.to_numpy().astype(np.int64).view(np.uint64) for c in batch.columns[1:])
                x, y = tile_links(a, None if same else b, radius)
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["a", "b"])

    bounded_batches(spark)
    return work.mapInArrow(frugal(run), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Documents are linked when their fingerprints differ in at most ``radius`` bits; component_id is the
    smallest doc_id reachable. Null counts as the empty text, whose fingerprint is zero and is linked like any
    other. Null ids are never the smallest (component_id is null if all are). Repeated rows are returned as they
    come, an empty table gives none, other columns are not read.
    """
    prints = staged(fingerprints(docs, width), "prints")
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    roots = components(fingerprint_links(nodes.select("fp"), radius))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = staged(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = staged(rooted.join(staged(least, "least"), "root").select("fp", "component_id"), "classes")
    return prints.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, width: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """Whole rows of ``docs``: of each group of ``near_duplicates`` the document that names it, and all rows with a null id.

    Null and empty texts are one group, whose smallest id stays. Rows of one id are one document: they go only if none of them names its
    group. Other columns stay as they are; an empty table gives no row. Only the ids that go are looked up; a table of them meets the rows by a join on doc_id.
    """
    judged = near_duplicates(docs, width, radius).where("doc_id is not null").select("doc_id", (F.col("doc_id") == F.col("component_id")).alias("stays"))
    gone = judged.groupBy("doc_id").agg(F.max("stays").alias("stays")).where(~F.col("stays")).select("doc_id")
    return docs.join(staged(gone, "gone"), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
