"""Language identification by hyperdimensional profiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofold.llm.batches import bounded_batches, frugal, valid_text

DIMENSIONS = 1024
SYMBOLS = 64
SEED = 20
UNKNOWN = "und"
_PLAIN = np.zeros(128, np.uint8)
_PLAIN[97:123] = np.arange(1, 27)
_HELD = 1_000_000
CHANCE = 3 / DIMENSIONS**0.5  # three standard deviations of the cosine with a random vector
ENOUGH_CHARS = 50  # of a text that must do better than chance


def letter_vectors() -> np.ndarray:
    """A random vector of +1 and -1 for each symbol, rolled by 2, 1 and 0 places for its place in the n-gram."""
    base = np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (SYMBOLS, DIMENSIONS))
    return np.stack([np.roll(base, k, axis=1) for k in (2, 1, 0)])


def grams(text: str | None) -> np.ndarray:
    """Codes of the letter trigrams of a text in lower case; all that are no letters count as one gap.

    Empty if the text has no letter. a to z are symbols of their own, other letters share the rest.
    """
    text = (text or "").lower()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    symbols = np.zeros(len(points), np.int32)
    plain = points < 128
    symbols[plain] = _PLAIN[points[plain]]
    other = np.flatnonzero(~plain)
    if len(other):
        kinds, which = np.unique(points[other], return_inverse=True)
        codes = [27 + c % (SYMBOLS - 27) if chr(c).isalpha() else 0 for c in kinds.tolist()]
        symbols[other] = np.array(codes, np.int32)[which]
    if not symbols.any():
        return symbols[:0]
    symbols = np.concatenate([[0], symbols, [0]])
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0)
    symbols = symbols[keep]
    return (symbols[:-2] * SYMBOLS + symbols[1:-1]) * SYMBOLS + symbols[2:]


def bundle(codes: np.ndarray, counts: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Sum of the n-gram vectors: each is the product of its three letter vectors."""
    total = np.zeros(DIMENSIONS, np.float64)
    for i in range(0, len(codes), 4096):
        c = codes[i : i + 4096]
        vectors = letters[0, c // SYMBOLS**2] * letters[1, c // SYMBOLS % SYMBOLS] * letters[2, c % SYMBOLS]
        total += counts[i : i + 4096].astype(np.float32) @ vectors.astype(np.float32)
    return total


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train_profiles(labelled: DataFrame) -> dict[str, np.ndarray]:
    """The prototype of each ``lang``: all its n-gram vectors bundled. Reads all rows with a lang.

    Tasks bundle what they read, so one vector per task and language is summed up by Spark; the driver
    gets one vector per language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_vectors()
        held: dict[str, list[np.ndarray]] = {}
        sizes: dict[str, int] = {}
        totals: dict[str, np.ndarray] = {}

        def settle(lang: str) -> None:
            found, counts = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
            totals[lang] = totals.get(lang, 0) + bundle(found, counts, letters)
            sizes[lang] = 0

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                codes = grams(text)
                held.setdefault(lang, []).append(codes)
                sizes[lang] = sizes.get(lang, 0) + len(codes)
                if sizes[lang] >= _HELD:
                    settle(lang)
        for lang in list(held):
            settle(lang)
        names = list(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([totals[n].astype(np.int64) for n in names], pa.list_(pa.int64()))],
            ["lang", "vector"],
        )

    bounded_batches(labelled.sparkSession)
    parts = labelled.where("lang is not null").select(F.make_valid_utf8(F.col("lang").cast("string")).alias("lang"), valid_text())
    sums = (
        parts.mapInArrow(frugal(run), "lang string, vector array<bigint>")
        .select("lang", F.posexplode("vector").alias("place", "value"))
        .groupBy("lang", "place")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    profiles: dict[str, np.ndarray] = {}
    for r in sums:
        profiles.setdefault(r["lang"], np.zeros(DIMENSIONS))[r["place"]] = r["value"]
    return {k: v / max(np.linalg.norm(v), 1.0) for k, v in sorted(profiles.items())}


def identify(
    docs: DataFrame, profiles: dict[str, np.ndarray], pred: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """``docs`` with the columns ``pred`` and ``score``, from the whole text alone.

    The score is the cosine with the nearest prototype, 0 where it would be negative. ``und`` and 0 for null
    texts, texts without letters, and if there is no prototype. Ties go to the lang that sorts first.
    Columns of these names are replaced; all rows and other columns stay. Bytes that are no UTF-8 stand as U+FFFD, in the result too.
    """
    names = list(profiles)
    table = np.array([profiles[n] for n in names]).reshape(len(names), DIMENSIONS)
    kept = [c for c in docs.columns if c not in (pred, score)]
    at = kept.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_vectors()
        for batch in batches:
            found, scores = [], []
            for text in batch.column(at).to_pylist():
                codes = grams(text)
                if not len(codes) or not names:
                    found.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                vector = bundle(*np.unique(codes, return_counts=True), letters)
                near = table @ vector / max(np.linalg.norm(vector), 1e-9)
                best = int(near.argmax())
                found.append(names[best])
                scores.append(float(min(max(near[best], 0.0), 1.0)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names, pred, score],
            )

    bounded_batches(docs.sparkSession)
    read = docs.select(*[valid_text().alias(c) if c == "text" else F.col(f"`{c}`") for c in kept])
    schema = T.StructType([*read.schema.fields, T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())])
    return read.mapInArrow(frugal(run), schema)


def accepted(
    docs: DataFrame,
    profiles: dict[str, np.ndarray],
    languages: list[str] | None = None,
    least_score: float = CHANCE,
    enough_chars: int = ENOUGH_CHARS,
) -> DataFrame:
    """Rows of ``docs`` whose text is in a language that was learnt, of ``languages`` if given; columns stay as they are.

    ``und`` is rejected, which null, empty and letterless texts get, and so are texts of ``enough_chars`` characters or more whose cosine with
    the nearest prototype is below ``least_score``: no language explains them better than chance. Shorter texts are judged
    by their letters alone, since few letters give no high cosine. Without any profile nothing can be judged: all rows stay.
    """
    if not profiles:
        return docs
    found = identify(docs, profiles, "_pred", "_cosine")
    stays = (F.col("_pred") != UNKNOWN) & ((F.col("_cosine") >= least_score) | (F.length("text") < enough_chars))
    if languages is not None:
        stays = stays & F.col("_pred").isin(languages)
    return found.where(stays).select(*[F.col(f"`{c}`") for c in docs.columns])
