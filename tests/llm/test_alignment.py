import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm._rows import awkward, documents
from wordloom.llm.alignment import Pairing, align, gallop
from wordloom.llm.packing import byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("seed", range(20))
def test_galloping_finds_lower_bounds(seed):
    rng = np.random.default_rng(seed)
    long = np.unique(rng.integers(0, 3000, rng.integers(1, 900)))
    short = np.unique(rng.integers(0, long[-1] + 1, rng.integers(1, 400)))
    assert gallop(short, long).tolist() == np.searchsorted(long, short).tolist()
    assert gallop(short[:0], long).tolist() == []


def brute(rows):
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = byte_letters()
    piece = lambda i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
    docs, counts = [], Counter()
    for d, t, *_ in rows:
        a = tok.encode(" " + (t or ""), add_special_tokens=False)
        ab, b = [bytes(letters[c] for c in w) for w in a.tokens], sp.encode(t or "")
        bb = [piece(i) for i in b]
        want = b" " + (t or "").encode()
        if not t or b"".join(ab) != want or b"".join(bb) != want:
            docs.append((d, [], [], [], ""))
            continue
        spans = []
        for ids, parts in ((a.ids, ab), (b, bb)):
            ends = np.cumsum([len(p) for p in parts]).tolist()
            spans.append(list(zip(ids, [0, *ends], ends)))
        links, j = [], 0
        for i, lo, hi in spans[0]:
            while spans[1][j][2] <= lo:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < hi:
                links.append((i, spans[1][k][0]))
                k += 1
        common = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        texts, lo = [], 0
        for hi in common:
            texts.append("|".join(",".join(str(i) for i, s, e in side if lo < e <= hi) for side in spans))
            lo = hi
        counts.update(set(links))
        docs.append((d, a.ids, b, links, ";".join(texts)))
    best = defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    return sorted((str(d), len(a), len(b), g.count(";") + 1 if g else 0, len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links), hashlib.sha256(g.encode()).hexdigest() if g else "") for d, a, b, links, g in docs)


def found(spark, rows, parts=3, **more):
    got = align(documents(spark, rows).repartition(parts), A, B, **more).collect()
    return sorted((str(r["doc_id"]), *(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))) for r in got)


ODD = [" ", "  ", "\n", "\t", "a", "B", "'s", "1", "é", "é", "▁", "_", " ", "​", "\x85", "\x1c", "中", "😀", "<|endoftext|>", "<s>", "<0x41>", " the", " une", " \n", "ﬁ", "、", "　"]


def odd_texts(n, seed=6):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(14))) for _ in range(n)]


def test_against_brute_force_on_awkward_rows(spark):
    rows = [*awkward(long_words=4000), (None, "no id"), (5, "repeated id"), (30, " " * 100_000), (31, "▁ none"), (32, "x" * 30_000)]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("head, held", ((1 << 20, 1 << 21), (40, 50), (0, 1)))
def test_frequent_and_rare_pairs_give_the_same_sums(spark, head, held):
    rows = list(enumerate(odd_texts(400) + ["the same words here"] * 60 + [None, ""]))
    assert found(spark, rows, head=head, held=held) == brute(rows)


def test_stretches_equal_whole_texts():
    pair = Pairing(A, B)
    assert pair.cuts
    tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    for t, a, b in zip(texts := [t for t in odd_texts(5000, 8) if t], *pair.encode(texts)):
        if a:
            assert np.frombuffer(a, "<u2").tolist() == tok.encode(" " + t, add_special_tokens=False).ids
            assert np.frombuffer(b, "<u2").tolist() == sp.encode(t)
        else:
            assert "▁" in t


def test_empty_table(spark):
    assert align(documents(spark, []), A, B).count() == 0
