import hashlib
import random
from collections import Counter

from tests.llm._rows import awkward, documents, prose
from wordloom.llm.grouping_sort import suffix_order
from wordloom.llm.suffix_dedup import dedup_text, removal


def test_suffix_order_against_sorting():
    rng = random.Random(0)
    for n in [0, 1, 2, 3, 5, 8, 20, 60, 200]:
        for k in (1, 2, 3, 9):
            for _ in range(20):
                s = [rng.randint(1, k) for _ in range(n)] + [0]
                assert suffix_order(s) == sorted(range(len(s)), key=lambda i: s[i:])


def slow(rows, length=200):
    texts = [(d, (t or "").encode()) for d, t, *_ in rows]
    seen = Counter(b[i : i + length] for _, b in texts for i in range(len(b) - length + 1))
    out = []
    for d, b in texts:
        mark = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                mark[i : i + length] = b"\1" * length
        kept = bytes(x for x, m in zip(b, mark) if not m)
        spans = sum(m and not (i and mark[i - 1]) for i, m in enumerate(mark))
        out.append((d, len(b), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def hard_rows(seed):
    rng = random.Random(seed)
    rows = awkward(seed, 3000)
    passages = [prose(rng, rng.randint(25, 90)) for _ in range(6)]
    for k in range(120):
        parts = [prose(rng, rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            if rng.random() < 0.5:
                i = rng.randrange(len(p))
                p = p[:i] + rng.choice(["", "X", "é"]) + p[i + rng.randint(0, 2) :]
            parts += [p[rng.randint(0, 40) : len(p) - rng.randint(0, 40)], prose(rng, rng.randint(0, 40))]
        rows.append((100 + k, " ".join(parts)))
    rows += [(300, "ab" * 400), (301, "a" * 199), (302, "a" * 200), (303, "b" * 201), (304, "\x00" * 300), (305, "q" * 199 + "\x00" * 210), rows[-1], (306, "é" * 150)]
    return rows


def test_against_brute_force(spark):
    rows = hard_rows(1)
    got = sorted(tuple(r) for r in removal(documents(spark, rows).repartition(5)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert got == slow(rows)


def test_hot_keys_and_small_spans(spark, monkeypatch):
    monkeypatch.setattr("wordloom.llm.suffix_dedup.HOT", 2)
    monkeypatch.setattr("wordloom.llm.suffix_dedup.SPAN", 1500)
    rows = hard_rows(2)
    got = sorted(tuple(r) for r in removal(documents(spark, rows)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert got == slow(rows)


def test_text_and_other_columns_stay(spark):
    rng = random.Random(4)
    p = prose(rng, 80)
    rows = [(1, "start " + p), (2, p + " end"), (3, None), (4, "short")]
    got = {r["doc_id"]: r for r in dedup_text(documents(spark, rows)).collect()}
    assert got[1]["text"].strip() == "start" and got[2]["text"].strip() == "end"
    assert got[3]["text"] is None and got[4]["text"] == "short" and got[1]["fingerprint"] == 7


def test_empty_table(spark):
    assert removal(documents(spark, [])).count() == 0
