import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm._rows import awkward, documents
from wordloom.llm.packing import Encoder, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(spark, rows, window=1024, parts=3):
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    want = {}
    for d, t, *_ in rows:
        want.setdefault(d, []).append([*tok.encode(t or "", add_special_tokens=False).ids, 0])
    got = pack(documents(spark, rows).repartition(parts), PATH, window, with_ids=True).toPandas()
    total = sum(len(x) for v in want.values() for x in v)
    assert got["length"].sum() == total
    for s, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g["offset"].to_numpy() == np.cumsum([0, *g["length"][:-1]])).all()
        assert g["length"].sum() == window or s == got["sequence_id"].max()
    assert got["sequence_id"].nunique() == -(-total // window)
    for d, g in got.groupby("doc_id"):
        for _, r in g.iterrows():
            piece = [x[r["start"] : r["start"] + r["length"]] for x in want[d] if len(x) == r["doc_tokens"]]
            assert list(r["ids"]) in piece
            assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
        assert g["first_piece"].sum() == g["last_piece"].sum() == len(want[d])
        assert g["length"].sum() == sum(map(len, want[d]))


def test_pieces_against_brute_force(spark):
    check(spark, awkward())


def test_small_window_ties_and_repeated_rows(spark):
    check(spark, [(1, "a b c"), (1, "a b c"), (2, "a b c"), (3, None)], window=2, parts=1)


def test_empty_table(spark):
    assert pack(documents(spark, []), PATH).count() == 0


def test_ids_equal_the_tokenizers_on_odd_texts():
    tok, encoder = Tokenizer.from_file(PATH), Encoder(PATH)
    tok.encode_special_tokens = True
    assert encoder.fast is not None
    rng = random.Random(3)
    letters = [" ", "  ", "\n", "\t", "\r", "a", "B", "'s", "'", "1", "\u00e9", "e\u0301", ".", "!", "_", "\u00a0", "\u200b", "\u0085", "\u001c", "\u4e2d", "\U0001f600", "<|endoftext|>", "zq" * 30]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(15))) for _ in range(20_000)]
    texts += [f"a{chr(c)}b {chr(c)} 1{chr(c)}" for c in range(0x3400) if c % 3 == 0]
    texts += [" " * 5000, "x" * 5000, " \n" * 3000, ""]
    want = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.encode(texts)] == want


def test_very_long_runs_of_white_space(spark):
    check(spark, [(1, " " * 1_000_000), (2, "a" + " \n" * 300_000 + "b"), (3, "\t" * 19_999 + "x"), (4, "x" * 200_000), (5, " " * 20_000)], window=4096)


def test_other_tokenizers_take_their_own_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, tok = Encoder(path), Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    assert encoder.fast is None
    assert encoder.encode(["Plain words, 12."])[0].tolist() == tok.encode("Plain words, 12.", add_special_tokens=False).ids
