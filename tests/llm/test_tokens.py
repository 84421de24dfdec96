import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from chronofold.llm import packing, token_files, tokens
from tests.llm.cases import LONG, ROWS, documents, empty

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
PARTS = ["a", "The", " ", "  ", "\n", "\t", " \n", ",", "...", "'s", "n't", "é", "ß", "ñandú", "漢字", "é", "́", "12", "3.5", "***", " ",
         "<|endoftext|>", "🙂", "İ", "Σ", "\x1c", " ", "-", "_", "&&&", "x\ny", "X.\nAb"]


def plain(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
def test_pieces_encode_like_whole_texts(name):
    rng = random.Random(5)
    texts = ["", " ", "\n", LONG[:3000], *["".join(rng.choices(PARTS, k=rng.randint(1, 12))) for _ in range(4000)]]
    texts += [" ".join(rng.choices(PARTS, k=rng.randint(1, 12))) for _ in range(2000)]
    encode, whole = tokens.Encoder(public_tokenizers.path(name)).encode, plain(name)
    for text, found in zip(texts, encode(texts), strict=True):
        assert np.frombuffer(found, "<u4").tolist() == whole(text), repr(text)


@pytest.mark.parametrize("name", FILES)
def test_special_tokens_are_what_the_library_makes_of_them(name):
    encode, whole = tokens.Encoder(public_tokenizers.path(name)).encode, plain(name)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y", " <|endoftext|><|endoftext|> ", "<|startoftext|>the <|END|> of", "a < b <|endof text|>"]
    assert len(whole(texts[1])) == 1
    assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == [whole(t) for t in texts]


@pytest.mark.parametrize("name", FILES)
def test_words_in_upper_and_lower_case(name):
    words = ["The", "the", "THE", "Éa", "éa", "ßß", "ÀÖØöøÿ", "x", "Zürich", "a" * 64]
    texts = [f"{a} {b}, {a}" for a in words for b in words]
    encode, whole = tokens.Encoder(public_tokenizers.path(name)).encode, plain(name)
    assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == [whole(t) for t in texts]


def test_full_caches_change_nothing():
    encoder = tokens.Encoder(public_tokenizers.path(FILES[0]), 2)
    texts = ["one two three", "two three four", "one two three"]
    assert [encoder.encode([t])[0] for t in texts] == tokens.Encoder(public_tokenizers.path(FILES[0])).encode(texts)


def test_rank_codes_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = rng.integers(0, 2 ** rng.integers(1, 33, n), n).astype(np.uint32)
        assert (token_files.unpack_ranks(*token_files.pack_ranks(ranks), n) == ranks).all()
    edges = np.array([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1], np.uint32)
    control, data = token_files.pack_ranks(edges)
    assert len(control) == 2 and len(data) == 2 * (1 + 2 + 3 + 4)
    assert (token_files.unpack_ranks(control, data, 8) == edges).all()


def test_blocks_round_trip():
    docs = [(3, np.array([1, 2, 700], np.uint32)), (None, np.array([5], np.uint32)), (-9, np.zeros(0, np.uint32))]
    back = list(token_files.read_blocks((token_files.write_block(docs) + b"\n") * 2))
    assert [(d, r.tolist()) for d, r in back] == [(d, r.tolist()) for d, r in docs] * 2


def test_rows_of_one_id_lie_in_several_files(spark, tmp_path):
    rows = [(None if k % 3 else 7, "the red house " * (k % 40), "en", "a") for k in range(300)]
    token_files.write_token_files(documents(spark, rows), str(tmp_path / "out"), public_tokenizers.path(FILES[0]), ids_per_file=1000)
    found = sorted((tuple(r) for r in token_files.read_token_files(spark, str(tmp_path / "out")).collect()), key=lambda r: r[1])
    want = expected_files(rows, FILES[0])
    assert [(r[0], r[1], r[2], r[3]) for r in found] == want
    files = [f for f in (tmp_path / "out" / "files").glob("*.txt") if f.stat().st_size]
    assert len(files) > 5 and max(f.stat().st_size for f in files) < 0.5 * sum(f.stat().st_size for f in files)


def expected_files(rows, name):
    whole, out, start = plain(name), [], 0
    made = [(i, np.array([*whole(t or ""), 2], "<u4")) for i, t, *_ in rows]
    for doc_id, ids in sorted(made, key=lambda x: (x[0] is not None, x[0] or 0, len(x[1]))):
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("per_file", [token_files.IDS_PER_FILE, 200])
def test_token_files(spark, tmp_path, per_file):
    path = public_tokenizers.path(FILES[0])
    token_files.write_token_files(documents(spark, clashes=True).repartition(3), str(tmp_path), path, ids_per_file=per_file)
    found = token_files.read_token_files(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected_files(ROWS, FILES[0])


def test_token_files_of_an_empty_table(spark, tmp_path):
    token_files.write_token_files(empty(spark), str(tmp_path), public_tokenizers.path(FILES[0]))
    assert token_files.read_token_files(spark, str(tmp_path)).count() == 0


def check_packed(rows, docs, name):
    whole = plain(name)
    ids = {}
    for i, t, *_ in docs:
        ids.setdefault((i, len(whole(t or "")) + 1), []).append(np.array([*whole(t or ""), 2], "<u4"))
    pieces, sequences = {}, {}
    for r in rows:
        assert r["length"] > 0
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert set(pieces) == set(ids)
    for key, own in pieces.items():
        assert sum(r["length"] for r in own) == key[1] * len(ids[key])
        for r in own:
            part = ids[key][0][r["start"] : r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
        starts = sorted((r["start"], r["length"]) for r in own)
        if len(ids[key]) == 1:
            assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False)) and starts[0][0] == 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == own[0]["tier"] <= 4096 and at & (at - 1) == 0


def test_packing(spark):
    path = public_tokenizers.path(FILES[1])
    rows = packing.pack_documents(documents(spark, clashes=True).repartition(3), path).collect()
    check_packed(rows, ROWS, FILES[1])
    assert packing.pack_documents(empty(spark), path).count() == 0


def test_packing_fills_windows_and_balances_groups():
    rng = random.Random(2)
    packer, rows = packing.Packer(group_tokens=8192), []
    sizes = [rng.choice([1, 5, 300, 700, 1500, 4096, 9000]) for _ in range(400)]
    for k, n in enumerate(sizes):
        rows += packer.add(k, np.full(n, k, "<u4").tobytes())
    rows += packer.finish()
    assert sum(r[2] for r in rows) == sum(sizes)
    windows = {r[5]: (r[7], r[8]) for r in rows}
    short = sum(1 for size, _ in windows.values() if size < 512)
    assert short <= 10  # of the stream's last windows only
    groups = {}
    for size, group in windows.values():
        groups[group] = groups.get(group, 0) + size
    assert max(groups.values()) <= 8192 + 4096
