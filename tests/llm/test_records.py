import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm._rows import awkward, documents
from wordloom.llm.checksums import BYTES, crc32c, masked
from wordloom.llm.records import framed, parsed, payload, read_records, round_trip, unframed, write_records
from wordloom.llm.word_encoder import StretchCache, WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_tokenizer(path=PATH):
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return tok


def check(spark, rows, parts=3):
    tok = plain_tokenizer()
    ids = [[*tok.encode(t or "", add_special_tokens=False).ids, 1] for _, t, *_ in rows]
    got = round_trip(documents(spark, rows).repartition(parts), PATH, with_ids=True).collect()
    got.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((d for d, *_ in rows), key=lambda d: (d is not None, d))
    assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == sorted((str(d), x) for (d, *_), x in zip(rows, ids))
    at = 0
    for r in got:
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]))
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
        at += r["n_tokens"]


def test_round_trip_of_awkward_rows(spark):
    check(spark, [*awkward(), (None, "no id"), (None, None), (20, " " * 1_000_000), (21, "Σας ΣΑΣ İ \x1c  <|endoftext|>")])


def test_ties_and_repeated_rows_over_many_files(spark):
    check(spark, [(7, f"word {i % 5}") for i in range(300)] + [(i, "x y") for i in range(9)], parts=5)


def test_empty_table(spark):
    assert round_trip(documents(spark, []), PATH).count() == 0


def test_ids_equal_the_library_on_odd_texts():
    rng = random.Random(5)
    letters = [" ", "  ", "\n", "\t", "\r", "a", "B", "'s", "'", "'LL", "1", "é", "é", "Σ", "ς", ".", "!", "_", " ", "​", "\x85", "\x1c", "中", "😀", "<|endoftext|>", "İ", "ſ", "ẞ", "²", "ª", "µ", "—", "’", "«", "×"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(15))) for _ in range(10_000)]
    texts += [f"a{chr(c)}b {chr(c)} 1{chr(c)}A {chr(c)}{chr(c)}" for c in range(0x3400)] + ["x" * 5000, "", " \n" * 3000]
    encoder = WordEncoder(PATH)
    assert encoder.pieces is not None
    want = [np.asarray(e.ids, dtype="<u2").tobytes() for e in plain_tokenizer().encode_batch(texts, add_special_tokens=False)]
    assert encoder.packed(texts) == want
    assert encoder.packed(texts) == want  # now from what is held


def test_other_splitters_get_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = WordEncoder(path)
    assert encoder.stretches is None
    assert np.frombuffer(encoder.packed(["two  words\n"])[0], dtype="<u2").tolist() == plain_tokenizer(path).encode("two  words\n", add_special_tokens=False).ids


def test_cache_forgets_and_stays_right(monkeypatch):
    monkeypatch.setattr("wordloom.llm.word_encoder.KEPT", 20)
    cache = StretchCache(lambda xs: [[len(x), ord(x[0])] for x in xs], 2)
    rng = random.Random(1)
    for _ in range(50):
        texts = [["abc"[rng.randrange(3)] * rng.randint(1, 60) for _ in range(8)] for _ in range(3)]
        assert cache.packed(texts) == [np.array([y for x in t for y in (len(x), ord(x[0]))], dtype="<u2").tobytes() for t in texts]
        assert len(cache.young) <= 40


def slow_crc(data):
    s = 0xFFFFFFFF
    for x in data:
        s = int(BYTES[(s ^ x) & 255]) ^ (s >> 8)
    return s ^ 0xFFFFFFFF


def test_checksums_against_byte_by_byte():
    rng = np.random.default_rng(4)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    start, length = rng.integers(0, 3000, 60), rng.integers(0, 1500, 60)
    length[:5] = 0, 1, 63, 64, 65
    assert crc32c(data, start, length).tolist() == [slow_crc(data[s : s + n].tolist()) for s, n in zip(start, length)]
    digits = np.frombuffer(b"123456789", dtype=np.uint8)
    assert crc32c(digits, np.array([0]), np.array([9])).tolist() == [0xE3069283]
    assert masked(np.array([0xE3069283], dtype=np.uint32)).tolist() == [(((0xE3069283 >> 15) | (0xE3069283 << 17)) + 0xA282EAD8) & 0xFFFFFFFF]


def test_frames_and_damage():
    records = [payload(5, b"\x01\x00\x02\x00", 2), payload(None, b"", 2), payload(-3, b"\x01\x00\x00\x00", 4)]
    data, at = framed(records)
    assert at.tolist() == [0, *np.cumsum([len(r) + 16 for r in records]).tolist()]
    assert unframed(data) == records and unframed(b"") == []
    assert [(k, i.tolist()) for k, i in map(parsed, records)] == [(5, [1, 2]), (None, []), (-3, [1])]
    for spot in (0, 9, 14, len(data) - 1):
        with pytest.raises(ValueError):
            unframed(data[:spot] + bytes([data[spot] ^ 1]) + data[spot + 1 :])


def test_single_records_by_the_index(spark, tmp_path):
    rows = [(i, f"word {i} of many") for i in range(50)]
    index = write_records(documents(spark, rows), str(tmp_path), PATH)
    assert {r["file"] for r in index.collect()} == set(os.listdir(tmp_path))
    for r in index.where("doc_id % 7 = 0").collect():
        with open(tmp_path / r["file"], "rb") as f:
            f.seek(r["at"])
            doc_id, ids = parsed(unframed(f.read(r["size"]))[0])
        assert (doc_id, len(ids)) == (r["doc_id"], r["n_tokens"])
    assert read_records(index.where("doc_id < 20"), str(tmp_path)).count() == 20
