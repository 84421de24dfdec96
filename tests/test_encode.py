import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chronofold.functions.wordpiece import Pieces, split_words, words_of
from chronofold.operators import codes, encode, render
from chronofold.plans.adapters import small_vocab, vocab_rows
from tests.helpers import events_df

VOCAB = dict(vocab_rows())
SAMPLES = [
    "Hello, world! it's 3.5mg/dL", "  spaced\tout\nlines ", "naïve café Ünïcode", "日本語 text 中", "a​b\u0000c�d",
    "emoji 😀 ok", "—dash– “quotes” ¿qué?", "x" * 101, "x" * 100, "", "...", "a b c", "₤$^`|~", "tab\x0bvt\x0cff",
]


def ad_special():
    return [(t, i) for t, i in vocab_rows() if t.startswith("[") and len(t) > 1]


def random_texts(n, seed=1):
    rng = random.Random(seed)
    alphabet = "abcXYZ 019.,-!é中 \t—ß×"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("lowercase", [False, True])
def test_tokens_agree_with_the_public_word_piece_library(spark, lowercase):
    tokenizers = pytest.importorskip("tokenizers")
    extra = {c: 900 + i for i, c in enumerate(["é", "##é", "e", "中", "naïve", "##日", "caf", "##ß", "×"])}
    vocab = extra | VOCAB
    library = tokenizers.BertWordPieceTokenizer(vocab, lowercase=lowercase)
    texts = SAMPLES + random_texts(500)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    look_up = Pieces(vocab, lowercase)
    for row in df.select("t", words_of(F.col("t")).alias("w")).collect():
        expected = library.encode(row.t, add_special_tokens=False).ids
        assert look_up(list(row.w))[0].tolist() == expected, row.t


def longest_first(vocab, word):
    """The rule as it is stated: the longest piece, then the longest continuation, and so on."""
    ids, rest, mark = [], word, ""
    while rest:
        size = next((n for n in range(len(rest), 0, -1) if mark + rest[:n] in vocab), 0)
        if size == 0:
            return [100]
        ids.append(vocab[mark + rest[:size]])
        rest, mark = rest[size:], "##"
    return ids if len(word) <= 100 else [100]


@pytest.mark.parametrize("seed", range(6))
def test_pieces_are_the_longest(seed):
    rng = random.Random(seed)
    letters = "ab" if seed < 3 else "abcdé"
    pieces = {("##" if rng.random() < 0.6 else "") + "".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(60)}
    vocab = dict(ad_special()) | {p: 200 + i for i, p in enumerate(sorted(pieces))}
    words = ["".join(rng.choices(letters + "#" * (seed % 2), k=rng.choice([0, 1, 3, 8, 30, 100, 101]))).replace("##", "#") for _ in range(800)]
    ids, counts = Pieces(vocab, False)(words)
    want = [longest_first(vocab, w) for w in words]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_long_words_take_linear_time():
    """A continuation that is long but never whole: trying every length would look at 50 characters from each place."""
    vocab = dict(ad_special()) | {"a": 200, "##a": 201, "##" + "a" * 50 + "b": 202, "a" * 50 + "b": 203}
    look_up = Pieces(vocab, False)
    steps = []
    plain = look_up._step
    look_up._step = lambda node, char: steps.append(len(node)) or plain(node, char)
    ids, _ = look_up(["a" * 100] * 10)
    assert ids.tolist() == ([200] + [201] * 99) * 10
    assert sum(steps) <= 10 * 2 * 101


def test_split_words_of_column_names():
    assert split_words("numeric_value") == ["numeric", "_", "value"]
    assert split_words("a b-c") == ["a", "b", "-", "c"]


def expected_ids(fields, length):
    """The rule on whole events, token by token: ids, types and places."""
    pieces = Pieces(VOCAB, False)
    look_up = lambda w: pieces([w])[0].tolist()
    tokens = []  # id, type, run
    runs = 0
    for name, value in fields:
        if value is None:
            continue
        tokens += [(i, 2, None) for w in split_words(name) for i in look_up(w)]
        if name == "code":
            tokens += [(i, 3, None) for w in split_words(value) for i in look_up(w)]
            continue
        for part in re.findall(r"[0-9]+(?:[.][0-9]*)?|[.]+|[^0-9.]+", value):
            if part[0] in "0123456789.":
                runs += 1
                tokens += [(look_up(c)[0], 3, runs) for c in part]
            else:
                tokens += [(i, 3, None) for w in split_words(part) for i in look_up(w)]
    tokens = tokens[: length - 2]
    places = [0] * len(tokens)
    for run in {t[2] for t in tokens} - {None}:
        at = [k for k, t in enumerate(tokens) if t[2] == run]
        dots = [j for j, k in enumerate(at) if tokens[k][0] == VOCAB["."]]
        for j, k in enumerate(at):
            if not dots:
                places[k] = len(at) + 5 - j
            elif len(dots) == 1:
                places[k] = dots[0] + 5 - j
    pad = [0] * (length - 2 - len(tokens))
    return (
        [101, *[t[0] for t in tokens], 102, *pad],
        [5, *[t[1] for t in tokens], 6, *pad],
        [0, *places, 0, *pad],
        len(tokens) + 2,
    )


def test_encoding_of_random_events(spark):
    rng = random.Random(9)
    alphabet = "abK 0123456789.,-"
    rows = []
    for seq in range(400):
        note = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25)))
        rows.append((1, 0, rng.choice(["LAB//5//x", "view", "", None]), None, seq, rng.choice([note, note, None])))
    df = events_df(spark, rows, ", note string").withColumn("note", F.regexp_replace("note", r"\.(?=\d)", ","))
    notes = {r.seq: r.note for r in df.collect()}
    for length in (8, 13, 40):
        found = {r.seq: r for r in encode.encode_events(df, small_vocab(spark), ["seq"], length).collect()}
        for row in rows:
            fields = [("code", row[2]), ("note", notes[row[4]])]
            if all(v is None for _, v in fields):
                assert row[4] not in found
                continue
            got = found[row[4]]
            assert (got.input_ids, got.type_ids, got.place_ids, got.n_tokens) == expected_ids(fields, length)


def test_number_cut_by_the_length_limit_counts_its_visible_part(spark):
    df = events_df(spark, [(1, 0, "view", 123.25, 1)])
    # [CLS] code view numeric _ value 1 2 [SEP]: two digits are left of 123.25
    row = encode.encode_events(df, small_vocab(spark), ["seq"], 9).first()
    assert row.place_ids == [0, 0, 0, 0, 0, 0, 7, 6, 0]
    assert row.type_ids == [5, 2, 3, 2, 2, 2, 3, 3, 6]


def test_event_text_order_nulls_and_skipped_columns(spark):
    df = events_df(
        spark,
        [(1, 0, "A", 36.6, 1, 5, 2, "x1", True), (1, 0, None, None, 2, 5, 2, None, None)],
        ", hadm_id bigint, width int, note string, flag boolean",
    )
    texts = [r[0] for r in df.select(render.event_text(df)).collect()]
    assert texts == ["code A numeric_value  3  6  .  6  note x 1  flag True", ""]
    assert render.render_events(df).count() == 1
    assert render.event_text(df, skip=["note", "flag", "hadm_id"]) is not None
    with_width = df.select(render.event_text(df, skip=["hadm_id", "note", "flag"])).first()[0]
    assert with_width.endswith("width  2 ")


def test_described_code_words_are_used(spark):
    df = events_df(spark, [(1, 0, "view", None, 1)])
    meta = spark.createDataFrame([("view", "Page seen")], "code string, description string")
    resolved = codes.resolve_codes(df.select("code").distinct(), meta)
    described = codes.describe_events(df, resolved.withColumn("code_words", words_of(F.col("code_text"))))
    row = encode.encode_events(described, small_vocab(spark), ["seq"], 8).first()
    assert row.input_ids[:5] == [101, VOCAB["code"], VOCAB["Page"], VOCAB["seen"], 102]


def test_vocab_is_checked(spark):
    with pytest.raises(ValueError, match="lacks"):
        encode.load_vocab(spark.createDataFrame([("a", 1)], "token string, id int"))
    bad = small_vocab(spark).union(spark.createDataFrame([("big", 40000)], "token string, id int"))
    with pytest.raises(ValueError, match="0..32767"):
        encode.load_vocab(bad)


def test_pages_bound_the_words_of_a_batch():
    sizes = [3, 0, 9, 1, 1, 40, 2, 2]
    words = pa.array([["w"] * n for n in sizes])
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sizes))), words, words], ["seq", "_words_0", "_words_1"])
    pages = list(encode._pages(batch.slice(1), ["_words_0", "_words_1"], 10))
    assert [p.column("seq").to_pylist() for p in pages] == [[1, 2], [3], [4, 5], [6, 7]]
