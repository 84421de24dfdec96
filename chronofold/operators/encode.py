"""Events to token, token-type and digit-place ids of fixed length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.functions.wordpiece import END, PAD, START, UNKNOWN, Pieces, split_words, words_of
from chronofold.operators.render import field_texts
from chronofold.schema import CODE, MAX_EVENT_LENGTH

# Token-type ids, and the place id of the decimal point.
TYPE_PAD, TYPE_NAME, TYPE_VALUE, TYPE_START, TYPE_END = 0, 2, 3, 5, 6
DOT_PLACE = 5

MAX_VOCAB = 32767  # ids are 16-bit
BATCH_BYTES = 16 * 1024 * 1024
WORDS_PER_PAGE = 50_000
_DIGITS = frozenset("0123456789.")


def load_vocab(vocab: DataFrame) -> dict[str, int]:
    """A token-id table as a dict. Ids must be 16-bit, so the table has at most 32,768 rows."""
    rows = vocab.select("token", F.col("id").cast("int")).limit(MAX_VOCAB + 2).collect()
    table = {token: number for token, number in rows}
    if len(rows) > MAX_VOCAB + 1 or any(not 0 <= i <= MAX_VOCAB for i in table.values()):
        raise ValueError(f"vocabulary ids must lie in 0..{MAX_VOCAB}")
    missing = [t for t in (PAD, UNKNOWN, START, END) if t not in table]
    if missing:
        raise ValueError(f"vocabulary lacks {missing}")
    return table


def field_words(
    events: DataFrame, keys: list[str], max_length: int | None, skip: list[str] | None = None
) -> tuple[DataFrame, list[str]]:
    """``keys`` and one word list per rendered field (null where the field is), with the field names.

    In fields other than the code a digit run is one word, so that its digits stay together until
    they are numbered. Every word gives at least one token, so words past ``max_length`` in a field
    lie behind the cut whatever comes before them and need not leave the JVM. None: no cut.
    """
    fields = field_texts(events, skip)
    lists = []
    for i, (name, text) in enumerate(fields):
        ready = name == CODE and "code_words" in events.columns
        words = F.col("code_words") if ready else words_of(text, numbers=name != CODE)
        lists.append((words if max_length is None else F.slice(words, 1, max_length)).alias(f"_words_{i}"))
    shown = F.coalesce(*[F.col(f"_words_{i}") for i in range(len(fields))]).isNotNull()
    return events.select(*keys, *lists).where(shown), [name for name, _ in fields]


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


def _ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lists of the given lengths: owner and place within its list of every element."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - _starts(counts)[owner]


def _pages(batch: pa.RecordBatch, columns: list[str], most: int = WORDS_PER_PAGE) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in runs of about ``most`` words; a single row may have more."""
    words = np.zeros(batch.num_rows, np.int64)
    for c in columns:
        words += np.diff(batch.column(c).offsets.to_numpy())
    page = (np.cumsum(words) - words) // most
    bounds = [0, *(np.flatnonzero(np.diff(page)) + 1), batch.num_rows]
    for start, end in zip(bounds, bounds[1:], strict=False):
        yield batch.slice(start, end - start)


class _Page:
    """Id matrices of one batch, filled field by field from the left."""

    def __init__(self, rows: int, length: int, special: dict[str, int]):
        self.length = length
        self.special = special
        self.used = np.zeros(rows, dtype=np.int64)
        self.ids = np.full((rows, length), special[PAD], dtype=np.int16)
        self.types = np.full((rows, length), TYPE_PAD, dtype=np.int16)
        self.places = np.zeros((rows, length), dtype=np.int16)

    def _put(self, row: np.ndarray, inside: np.ndarray, ids: np.ndarray, kind: int):
        """Write tokens after what each row holds; tokens beyond the cut are dropped."""
        at = self.used[row] + inside + 1
        kept = at < self.length - 1
        self.ids[row[kept], at[kept]] = ids[kept]
        self.types[row[kept], at[kept]] = kind
        return at, kept

    def _put_places(self, row: np.ndarray, at: np.ndarray, places: np.ndarray) -> None:
        self.places[row, at] = places

    def add_name(self, shown: np.ndarray, ids: np.ndarray) -> None:
        rows = np.flatnonzero(shown)
        self._put(np.repeat(rows, len(ids)), np.tile(np.arange(len(ids)), len(rows)), np.tile(ids, len(rows)), TYPE_NAME)
        self.used[rows] += len(ids)

    def add_words(self, words: pa.ListArray, look_up: Pieces, dot: int, numbers: bool) -> None:
        offsets = words.offsets.to_numpy()
        coded = words.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        unique = coded.dictionary.to_pylist()
        word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        is_run = np.array([numbers and w[0] in _DIGITS for w in unique], dtype=bool)
        parts = [list(w) if run else [w] for w, run in zip(unique, is_run)]  # a run character by character
        pool, per_part = look_up([p for ps in parts for p in ps])
        n_pieces = np.zeros(len(unique), np.int64)
        np.add.at(n_pieces, np.repeat(np.arange(len(unique)), list(map(len, parts))), per_part)

        word_row, _ = _ragged(np.diff(offsets))
        token_word, in_word = _ragged(n_pieces[word])
        ids = pool[_starts(n_pieces)[word[token_word]] + in_word] if len(token_word) else pool
        row = word_row[token_word]
        per_row = np.bincount(row, minlength=len(self.used))
        at, kept = self._put(row, np.arange(len(row)) - _starts(per_row)[row], ids, TYPE_VALUE)
        self.used += per_row

        # Places count within a digit run, as far as the run is kept.
        digit = kept & is_run[word[token_word]] if len(token_word) else kept
        if digit.any():
            run, index, is_dot = token_word[digit], in_word[digit], ids[digit] == dot
            size = np.bincount(run, minlength=len(word))[run]
            dots = np.bincount(run, weights=is_dot, minlength=len(word))[run]
            dot_index = np.zeros(len(word), dtype=np.int64)
            dot_index[run[is_dot]] = index[is_dot]
            places = np.select(
                [dots == 0, dots == 1], [size + DOT_PLACE - index, dot_index[run] + DOT_PLACE - index], 0
            )
            self._put_places(row[digit], at[digit], places)

    def finish(self) -> list[pa.Array]:
        rows, length = self.ids.shape
        kept = np.minimum(self.used, length - 2)
        every = np.arange(rows)
        self.ids[:, 0], self.types[:, 0] = self.special[START], TYPE_START
        self.ids[every, kept + 1], self.types[every, kept + 1] = self.special[END], TYPE_END
        bounds = pa.array(np.arange(0, (rows + 1) * length, length, dtype=np.int32))
        return [
            pa.ListArray.from_arrays(bounds, pa.array(m.reshape(-1)))
            for m in (self.ids, self.types, self.places)
        ] + [pa.array((kept + 2).astype(np.int32))]


class _Parts(_Page):
    """A page whose rows go on in further rows instead of being cut."""

    def __init__(self, rows: int, length: int, special: dict[str, int]):
        super().__init__(rows, 2, special)
        self.part_length = length
        self.tokens: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]] = []
        self.digits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def _put(self, row: np.ndarray, inside: np.ndarray, ids: np.ndarray, kind: int):
        at = self.used[row] + inside
        self.tokens.append((row, at, ids, kind))
        return at, np.ones(len(row), dtype=bool)

    def _put_places(self, row: np.ndarray, at: np.ndarray, places: np.ndarray) -> None:
        self.digits.append((row, at, places))

    def finish_parts(self) -> tuple[np.ndarray, np.ndarray, list[pa.Array]]:
        """Row and number of each part, and the id lists."""
        room = self.part_length - 2
        parts = np.maximum(-(-self.used // room), 1)
        owner, number = _ragged(parts)
        page = _Page(len(owner), self.part_length, self.special)
        first = _starts(parts)
        for row, at, ids, kind in self.tokens:
            to = first[row] + at // room, at % room + 1
            page.ids[to], page.types[to] = ids, kind
        for row, at, places in self.digits:
            page.places[first[row] + at // room, at % room + 1] = places
        page.used = np.minimum(self.used[owner] - number * room, room)
        return owner, number, page.finish()


def encode_events(
    events: DataFrame,
    vocab: DataFrame,
    keys: list[str],
    max_length: int = MAX_EVENT_LENGTH,
    lowercase: bool = False,
    skip: list[str] | None = None,
    in_parts: bool = False,
) -> DataFrame:
    """``keys`` plus ``input_ids``, ``type_ids``, ``place_ids`` (SMALLINT lists) and ``n_tokens``.

    Text work is done in column expressions; only the piece lookup and the padding run on Arrow
    batches, where each distinct word of a batch is looked up once. The step is narrow: nothing is
    shuffled, and equal words need not meet. Events without any field to show are dropped.

    Arrow batches are kept to ``BATCH_BYTES`` for the rest of the session and worked through in pages of ``WORDS_PER_PAGE`` words, so that
    the memory of a Python worker does not follow the length of its texts or the rows of its task.

    An event is cut at ``max_length``. With ``in_parts`` it goes on in further rows instead, numbered by ``part``
    from 0; digit places then count within the whole run.
    """
    events.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    table = load_vocab(vocab)
    special = {t: table[t] for t in (PAD, UNKNOWN, START, END)}
    dot = table.get(".", -1)
    shared = events.sparkSession.sparkContext.broadcast(Pieces(table, lowercase))
    prepared, names = field_words(events, keys, None if in_parts else max_length, skip)
    name_words = [split_words(n) for n in names]
    part = ["part"] if in_parts else []
    outputs = ["input_ids", "type_ids", "place_ids", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look_up = shared.value
        name_ids = [look_up(ws)[0] for ws in name_words]
        lists_of = [f"_words_{i}" for i in range(len(names))]
        for batch in (page for whole in batches for page in _pages(whole, lists_of)):
            page = (_Parts if in_parts else _Page)(batch.num_rows, max_length, special)
            for i, name in enumerate(names):
                column = batch.column(f"_words_{i}")
                page.add_name(column.is_valid().to_numpy(zero_copy_only=False), name_ids[i])
                page.add_words(column, look_up, dot, numbers=name != CODE)
            columns = [batch.column(k) for k in keys]
            if in_parts:
                owner, number, lists = page.finish_parts()
                columns = [c.take(pa.array(owner)) for c in columns] + [pa.array(number.astype(np.int32))]
            else:
                lists = page.finish()
            yield pa.RecordBatch.from_arrays(columns + lists, [*keys, *part, *outputs])

    kept = ", ".join(f"`{k}` {prepared.schema[k].dataType.simpleString()}" for k in keys)
    lists = ", ".join([*[f"{c} int" for c in part], *[f"{c} array<smallint>" for c in outputs[:3]]])
    return prepared.mapInArrow(run, f"{kept}, {lists}, n_tokens int")
