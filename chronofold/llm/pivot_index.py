"""Near copies of embeddings by a permutation index: vectors are described by their nearest pivots, in order.

Vectors that lie close together have most of their nearest pivots in common. Each pivot has an inverted list of the vectors that
name it; vectors that meet in a list and share enough pivots are verified by their cosine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from chronofold.llm.batches import bounded_batches, frugal
from chronofold.llm.graph import Forest, components
from chronofold.sources.staging import staged

COSINE = 0.98
NAMED = 8  # pivots that describe a vector
SHARED = 3  # pivots that two vectors must share
FEWEST_PIVOTS, MOST_PIVOTS = 64, 8_192
SEPARATION = 0.8  # cosine that no two pivots exceed
BLOCK = 2_048  # entries of a piece of an inverted list, on average
TILE = 256
ONE = 32_767  # the code of 1.0
SEED = 11

COUNT, LINK, OPEN = 0, 1, 2  # kinds of findings: links of a vector, a link that joins two trees, a pair to be verified exactly


def usable(embedding: Column) -> Column:
    """No null, no null or non-finite component, not all zero."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return embedding.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(embedding, lambda x: x != 0)


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by the largest component first, so that no square over- or underflows."""
    scaled = vectors / np.abs(vectors).max(1)[:, None]
    return scaled / np.sqrt((scaled * scaled).sum(1))[:, None]


def pivots_wanted(n: int) -> int:
    """A power of two from four times the root of the number of vectors, so that lists grow with the root as well."""
    return min(MOST_PIVOTS, max(FEWEST_PIVOTS, 1 << math.ceil(math.log2(4 * math.sqrt(max(n, 1))))))


def separated(sample: np.ndarray, n: int, width: int) -> np.ndarray:
    """At most ``n`` rows of ``sample`` (unit vectors), none closer to an earlier one than SEPARATION, filled up to
    FEWEST_PIVOTS with random directions. A large group of near copies thus has one pivot of its own, and its members agree on the next ones."""
    chosen = np.empty((0, width))
    for i in range(0, len(sample), TILE):
        if len(chosen) >= n:
            break
        some = sample[i : i + TILE]
        some = some[(some @ chosen.T).max(1, initial=-1.0) <= SEPARATION]
        near = some @ some.T
        kept: list[int] = []
        for k in range(len(some)):
            if not kept or near[k, kept].max() <= SEPARATION:
                kept.append(k)
        chosen = np.concatenate([chosen, some[kept]])
    missing = max(0, min(n, FEWEST_PIVOTS) - len(chosen))
    return np.concatenate([chosen[:n], units(np.random.default_rng(SEED).standard_normal((missing, width)))])


def describe(vectors: np.ndarray, pivots: np.ndarray, named: int) -> np.ndarray:
    """Numbers of the ``named`` nearest pivots of each unit vector, nearest first."""
    near = vectors @ pivots.T
    best = np.argpartition(-near, named - 1, axis=1)[:, :named]
    order = np.lexsort((best, -np.take_along_axis(near, best, 1)), axis=1)
    return np.take_along_axis(best, order, 1)


def shared_pivots(a: np.ndarray, b: np.ndarray, pivot: int) -> tuple[np.ndarray, np.ndarray]:
    """For all pairs of rows of ``a`` and ``b`` the number of shared pivots, and whether one lies before ``pivot``."""
    found = np.zeros((len(a), len(b)), np.uint16)
    for i in range(a.shape[1]):
        worth = np.where(a[:, i] < pivot, 257, 1).astype(np.uint16)[:, None]
        for j in range(b.shape[1]):
            found += (a[:, i, None] == b[None, :, j]) * worth
    return found & 255, found > 255


def block_findings(
    pivot: int, a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...] | None, cosine: float, shared: int
) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]], list[tuple[int, int]]]:
    """Links found within a piece of the list of ``pivot`` (``b`` None) or between two pieces.

    A piece is (copies, codes, pivots) with a row per vector. Pairs that share enough pivots, none of which comes before this one (they have met there),
    are compared by their codes; codes are off by at most half a unit per component, which bounds the cosine. Returns the copies each row of ``a`` and of ``b`` is linked to,
    links (positions, those of ``b`` behind those of ``a``) that connect all that is linked, and pairs that the bound leaves open.
    """
    same = b is None
    copies_a, codes_a, named_a = a
    copies_b, codes_b, named_b = a if same else b
    shift = 0 if same else len(copies_a)
    forest = Forest(len(copies_a) + (0 if same else len(copies_b)))
    linked_a, linked_b = np.zeros(len(copies_a), np.int64), np.zeros(len(copies_b), np.int64)
    off = math.sqrt(codes_a.shape[1]) / ONE * (1 + 1 / ONE) + 1e-12
    unsure: list[tuple[int, int]] = []
    for i in range(0, len(copies_a), TILE):
        x, left = slice(i, i + TILE), codes_a[i : i + TILE].astype(np.float64)
        for j in range(i if same else 0, len(copies_b), TILE):
            y = slice(j, j + TILE)
            count, before = shared_pivots(named_a[x], named_b[y], pivot)
            met = (count >= shared) & ~before
            if same and i == j:
                met = np.triu(met, 1)
            rows, cols = np.nonzero(met)
            if not len(rows):
                continue
            right = codes_b[y].astype(np.float64)
            if len(rows) * 8 > met.size:
                near = (left @ right.T)[rows, cols]
            else:
                near = np.concatenate(
                    [np.einsum("ij,ij->i", left[rows[k : k + 4096]], right[cols[k : k + 4096]]) for k in range(0, len(rows), 4096)]
                )
            near /= ONE * ONE  # sums of whole numbers below 2 ** 53: exact in any order
            sure = near - off >= cosine
            maybe = ~sure & (near + off >= cosine)
            unsure += zip((rows[maybe] + i).tolist(), (cols[maybe] + j + shift).tolist(), strict=True)
            rows, cols = rows[sure], cols[sure]
            np.add.at(linked_a, rows + i, copies_b[y][cols])
            np.add.at(linked_b, cols + j, copies_a[x][rows])
            new = forest.parent[rows + i] != forest.parent[cols + j + shift]
            forest.add(rows[new] + i, cols[new] + j + shift)
    return linked_a, linked_b, forest.links, unsure


def _piece(batch: pa.RecordBatch, row: int, at: int, named: int) -> tuple[np.ndarray, tuple[np.ndarray, ...]] | None:
    if not batch.column(at)[row].is_valid:
        return None
    names, copies, codes, pivots = (batch.column(at + c)[row].values for c in range(4))
    joined = np.frombuffer(b"".join(codes.to_pylist()), "<i2").reshape(len(names), -1)
    described = np.frombuffer(b"".join(pivots.to_pylist()), "<i2").reshape(len(names), named)
    return names.to_numpy(), (copies.to_numpy(), joined, described)


def described_vectors(nodes: DataFrame, named: int) -> tuple[DataFrame, int]:
    """``nodes`` as label, size, node, copies, codes and the pivots that describe them, by number; and the number of pivots.

    Pivots come from a sample of at most four times their number, drawn by a hash, and are few: at most 8,192 of a size. How often each is named is counted over all vectors.
    """
    spark = nodes.sparkSession
    wanted = pivots_wanted(nodes.count())
    drawn: dict[int, list[list[float]]] = {}
    for r in nodes.orderBy(F.xxhash64("v"), "node").limit(4 * wanted).select("v").collect():
        drawn.setdefault(len(r["v"]), []).append(r["v"])
    made = {width: separated(units(np.array(rows, np.float64)), wanted, width) for width, rows in drawn.items()}
    shipped = spark.sparkContext.broadcast(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = dict(shipped.value)
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            codes, found = [b""] * len(sizes), [b""] * len(sizes)
            for width in np.unique(sizes).tolist():
                if width not in pivots:
                    pivots[width] = separated(np.empty((0, width)), wanted, width)
                rows = np.flatnonzero(sizes == width)
                vectors = batch.column("v").take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
                unit = units(vectors.astype(np.float64).reshape(-1, width))
                for k in range(0, len(rows), TILE):
                    some, some_rows = unit[k : k + TILE], rows[k : k + TILE]
                    best = describe(some, pivots[width], named).astype("<i2")
                    whole = np.rint(some * ONE).astype("<i2")
                    for r, p, c in zip(some_rows.tolist(), best, whole, strict=True):
                        codes[r], found[r] = c.tobytes(), np.sort(p).tobytes()
            kept = [batch.column(c) for c in ("label", "size", "node", "copies")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(codes, pa.binary()), pa.array(found, pa.binary())],
                ["label", "size", "node", "copies", "codes", "pivots"],
            )

    bounded_batches(spark)
    schema = nodes.select("label", "size", "node", "copies").schema.add("codes", "binary").add("pivots", "binary")
    return staged(nodes.select("label", "size", "node", "copies", "v").mapInArrow(frugal(run), schema), "described"), wanted


def pivot_ranks(described: DataFrame, wanted: int) -> np.ndarray:
    """The number of each pivot when they are counted from the rarest on; one table of at most 8,192 counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(wanted, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i2"), minlength=wanted)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["pivot", "n"])

    bounded_batches(described.sparkSession)
    often = described.select("pivots").mapInArrow(frugal(run), "pivot int, n bigint").groupBy("pivot").agg(F.sum("n").alias("n"))
    rank = np.full(wanted, wanted - 1, np.int64)
    for k, r in enumerate(often.orderBy("n", "pivot").collect()):
        rank[r["pivot"]] = k
    return rank


def inverted_lists(described: DataFrame, rank: np.ndarray, named: int, shared: int) -> DataFrame:
    """``described`` once for each of a vector's ``named - shared + 1`` rarest pivots, with ``pivot``, the list it stands in.

    Two vectors that share ``shared`` pivots have the rarest of these among those entries, so a list holds them both. Pivots
    are numbered by ``rank``.
    """
    entries, names = named - shared + 1, described.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivots = np.frombuffer(b"".join(batch.column("pivots").to_pylist()), "<i2").reshape(batch.num_rows, named)
            ranked = np.sort(rank[pivots], axis=1).astype("<i2")
            again = pa.array(np.repeat(np.arange(batch.num_rows), entries))
            by_rank = pa.array([r.tobytes() for r in ranked], pa.binary())
            kept = [(by_rank if c == "pivots" else batch.column(c)).take(again) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(ranked[:, :entries].ravel().astype(np.int32))], [*names, "pivot"])

    bounded_batches(described.sparkSession)
    return described.mapInArrow(frugal(run), StructType([*described.schema.fields, StructField("pivot", IntegerType())]))


def list_findings(
    described: DataFrame, rank: np.ndarray, cosine: float, named: int, shared: int, block: int = BLOCK
) -> DataFrame:
    """kind, a, b, n: what ``block_findings`` finds in all inverted lists.

    A list of up to ``block`` entries is one row. A longer one is cut in pieces by a hash; each piece meets itself and every later piece of its
    list. Entries move once, to their list; only the pieces of long lists are written, and meet in a join.
    """
    key = ["label", "size", "pivot"]
    keys = inverted_lists(described.select("label", "size", "pivots"), rank, named, shared)
    lengths = keys.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("pieces"))
    long = staged(lengths.where("pieces > 1"), "long-lists")
    columns = ("node", "copies", "codes", "pivots")
    piece = F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int").alias("piece")
    lists = (
        inverted_lists(described, rank, named, shared).join(long, key, "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
        .groupBy(*key, "pieces", piece).agg(F.collect_list(F.struct(*columns)).alias("rows"))
        .select(*key, "pieces", "piece", *[F.col(f"rows.{c}").alias(c) for c in columns])
    )
    nothing = [F.lit(None).cast(lists.schema[c].dataType).alias(f"{c}_b") for c in columns]
    n_pairs = long.agg(F.sum(F.col("pieces").cast("double") * (F.col("pieces") + 1) / 2)).first()[0]
    if n_pairs is None:
        work = lists.select("pivot", *columns, *nothing)
    else:
        pieces = staged(lists.where("pieces > 1"), "pieces")
        later = pieces.select(*key, F.col("piece").alias("piece_b"), *[F.col(c).alias(f"{c}_b") for c in columns])
        first = pieces.where("piece < pieces - 1").withColumn("piece_b", F.explode(F.expr("sequence(piece + 1, pieces - 1)")))
        between = first.join(later, [*key, "piece_b"]).select("pivot", *columns, *[f"{c}_b" for c in columns])
        spread = pieces.select("pivot", *columns, *nothing).unionByName(between).repartition(int(max(8, min(2 * n_pairs, 4096))))
        work = lists.where("pieces = 1").select("pivot", *columns, *nothing).unionByName(spread)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                names, a = _piece(batch, r, 1, named)
                other = _piece(batch, r, 5, named)
                names_b, b = other or (names[:0], None)
                to_a, to_b, links, unsure = block_findings(batch.column(0)[r].as_py(), a, b, cosine, shared)
                every = np.concatenate([names, names_b])
                linked = np.concatenate([to_a, to_b]) if b is not None else to_a + to_b
                some = np.flatnonzero(linked)
                pairs = np.array([*links, *unsure], np.int64).reshape(-1, 2)
                kind = np.repeat([COUNT, LINK, OPEN], [len(some), len(links), len(unsure)])
                left = np.concatenate([every[some], every[pairs[:, 0]]])
                right = np.concatenate([every[some], every[pairs[:, 1]]])
                n = np.concatenate([linked[some], np.zeros(len(pairs), np.int64)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kind, pa.int32()), pa.array(left), pa.array(right), pa.array(n)], ["kind", "a", "b", "n"]
                )

    bounded_batches(described.sparkSession)
    return work.mapInArrow(frugal(run), "kind int, a bigint, b bigint, n bigint")


def _cosine(x: str, y: str) -> Column:
    """Of two arrays of doubles, each scaled by its largest component."""

    def scaled(v: str) -> Column:
        most = F.array_max(F.transform(v, F.abs))
        return F.transform(v, lambda e: e / most)

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, e: s + e)

    a, b = scaled(x), scaled(y)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def near_copies(
    embeddings: DataFrame, cosine: float = COSINE, named: int = NAMED, shared: int = SHARED, block: int = BLOCK
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors of one label and length whose cosine is at least ``cosine`` are linked if they share ``shared`` of the ``named`` pivots
    nearest to them; there is no other limit on what is found. n_links counts the rows linked directly, component_id is the smallest vec_id reachable, kept
    tells whether that is the row's own. Vectors that are null, zero or hold null or non-finite components, and rows with a null label,
    are linked with nothing. Null ids are never the smallest (component_id is null, and kept true, if all are). Repeated rows count each; rows of one id may differ in their
    vectors. An empty table gives no row; other columns are not read.

    Equal vectors of a label are one node with a number of copies, so a group of copies is never compared. Pairs are not written out: tasks return counts
    per vector and the links that join two trees; only pairs within some 2 ** -12 of the threshold are written, and verified on the vectors themselves.
    """
    rows = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label"), F.col("embedding").alias("v")
    )
    fit = F.coalesce(usable(F.col("v")), F.lit(False)) & F.col("label").isNotNull()
    keyed = rows.withColumn("fit", fit).withColumns({f"h{s}": F.xxhash64(F.lit(s), "v") for s in (1, 2)})
    key = ["label", "h1", "h2"]
    nodes = staged(
        keyed.where("fit").groupBy(*key).agg(F.first("v").alias("v"), F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .select("*", F.size("v").alias("size"), F.monotonically_increasing_id().alias("node")),
        "nodes",
    )
    described, wanted = described_vectors(nodes, named)
    rank = pivot_ranks(described, wanted)
    found = staged(list_findings(described, rank, cosine, named, shared, block), "findings")

    ends = [nodes.select(F.col("node").alias(e), F.col("v").cast("array<double>").alias(f"v_{e}"), F.col("copies").alias(f"copies_{e}")) for e in "ab"]
    verified = found.where(F.col("kind") == OPEN).select("a", "b").join(ends[0], "a").join(ends[1], "b")
    verified = staged(verified.where(_cosine("v_a", "v_b") >= cosine).select("a", "b", "copies_a", "copies_b"), "verified")
    counts = (
        found.where(F.col("kind") == COUNT).select(F.col("a").alias("node"), "n")
        .unionByName(verified.select(F.col("a").alias("node"), F.col("copies_b").alias("n")))
        .unionByName(verified.select(F.col("b").alias("node"), F.col("copies_a").alias("n")))
        .groupBy("node").agg(F.sum("n").alias("n"))
    )
    roots = components(found.where(F.col("kind") == LINK).select("a", "b").unionByName(verified.select("a", "b")))
    rooted = staged(
        nodes.select(*key, "node", "first_id", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted"
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    grouped = (
        rooted.join(staged(least, "least"), "root").join(counts, "node", "left")
        .select(*key, (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n"), "component_id")
        .where("n > 0").select(F.col("label").alias("_label"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "n", "component_id")
    )
    same = F.col("fit") & (F.col("label") == F.col("_label")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    joined = keyed.select("vec_id", "fit", *key).join(staged(grouped, "grouped"), same, "left")
    component = F.when(F.col("n").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
