import random

import numpy as np
import xxhash

from tests.llm._rows import awkward, documents, prose
from wordloom.llm.graph import connected_components
from wordloom.llm.simhash import ACCEPT, hex16, keep_one, links, near_duplicates, shingles, shingle_set, similar_links, similar_within, wide_fingerprint

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_print(text):
    words = (text or "").translate(LOWER).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    ones = [0] * 64
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), seed=42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(parts))


def slow_components(prints, radius=3):
    ids = {f: i for i, f in enumerate(sorted(set(prints)))}
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    fps = list(ids)
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                parent[root(i)] = root(j)
    return {f: root(i) for f, i in ids.items()}


def test_against_brute_force(spark):
    rng = random.Random(5)
    rows = awkward(3, 4000)
    base = [prose(rng, rng.randint(40, 300)) for _ in range(15)]
    for k in range(150):
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = "changed"
        rows.append((100 + k, " ".join(words)))
    rows.append((100, rows[-1][1]))
    got = near_duplicates(documents(spark, rows)).select("doc_id", hex16("fp").alias("fp"), "component_id").collect()
    assert len(got) == len(rows)
    prints = {(d, f"{slow_print(t):016x}") for d, t, *_ in rows}
    assert {(r["doc_id"], r["fp"]) for r in got} == prints
    comp = slow_components([int(f, 16) for _, f in prints])
    low = {}
    for d, f in prints:
        c = comp[int(f, 16)]
        low[c] = min(d, low.get(c, d))
    assert all(r["component_id"] == low[comp[int(r["fp"], 16)]] for r in got)


def near_cluster(rng, n):
    out = {rng.getrandbits(64)}
    while len(out) < n:
        out.add(rng.choice(list(out)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    return out


def test_links_for_all_part_layouts(spark, monkeypatch):
    rng = random.Random(2)
    fps = {0, (1 << 64) - 1} | near_cluster(rng, 120) | near_cluster(rng, 60) | {rng.getrandbits(64) for _ in range(200)}
    # A frequent value in the low half: thresholds must move to other parts.
    fps |= {(rng.getrandbits(32) << 32) | 0xDEADBEEF for _ in range(150)}
    want = slow_components(fps)
    nodes = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long").repartition(3)
    for widths in ([16] * 4, [22, 21, 21], [32, 32]):
        for hot in (30_000, 20):
            monkeypatch.setattr("wordloom.llm.simhash.HOT", hot)
            got = {f: f for f in fps}
            for r in connected_components(links(nodes, 3, widths)).collect():
                got[r["node"] & (2**64 - 1)] = r["component"] & (2**64 - 1)
            groups, wanted = {}, {}
            for f in fps:
                groups.setdefault(got[f], set()).add(f)
                wanted.setdefault(want[f], set()).add(f)
            assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_empty_table(spark):
    assert near_duplicates(documents(spark, [])).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1000), (900, 901)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert all(got[i] == 0 for i in range(301)) and got[901] == 900


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_similar_links_are_exact_and_find_nearly_all(spark, monkeypatch):
    rng = random.Random(8)
    texts = []
    for _ in range(40):
        words = prose(rng, 150).split()
        for changes in (0, 1, 2, 3, 4, 6, 9):  # similarities from 0.6 to 1
            near = list(words)
            for at in rng.sample(range(150), changes):
                near[at] = f"w{rng.random()}"
            texts.append(" ".join(near))
    sets = [set(shingles(t, 5)) for t in texts]
    wanted = {(i, j) for i in range(len(sets)) for j in range(i) if jaccard(sets[i], sets[j]) >= 0.8}
    rows, packed = [], []
    for k, t in enumerate(texts):
        hashes = shingle_set(t)
        rows.append((k, *wide_fingerprint(hashes).view(np.int64).tolist()))
        packed.append((k, bytearray((hashes >> np.uint64(32)).astype("<u4").tobytes())))
    nodes = spark.createDataFrame(rows, "id long, " + ", ".join(f"w{k} long" for k in range(6))).repartition(3)
    table = spark.createDataFrame(packed, "id long, shingles binary")
    for hot, size in ((30_000, 32 << 20), (5, 1500)):
        monkeypatch.setattr("wordloom.llm.simhash.HOT", hot)
        monkeypatch.setattr("wordloom.llm.simhash.SET_BYTES", size)
        component = {k: k for k in range(len(texts))}
        component.update({r["node"]: r["component"] for r in connected_components(similar_links(nodes, table)).collect()})
        met = sum(component[i] == component[j] for i, j in wanted)
        exact = {k: k for k in component}
        for i, j in sorted(wanted):
            low, high = sorted((exact[i], exact[j]))
            exact = {k: low if v == high else v for k, v in exact.items()}
        # No component joins what exact links don't join.
        assert all(exact[k] == exact[c] for k, c in component.items())
        assert len(wanted) > 150 and met >= 0.95 * len(wanted)


def test_similar_within_is_exact():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 60)).astype(np.uint32)) for _ in range(80)] * 2
    pairs = similar_within(sets)
    share = lambda i, j: len(np.intersect1d(sets[i], sets[j])) / len(np.union1d(sets[i], sets[j]))
    assert all(share(i, j) >= 0.8 for i, j in pairs) and len(pairs) < len(sets)
    label = list(range(len(sets)))
    for i, j in pairs:
        label = [label[i] if v == label[j] else v for v in label]
    assert all(label[i] == label[j] for i in range(len(sets)) for j in range(i) if share(i, j) >= 0.8)
    assert similar_within([]) == []


def test_keep_one_takes_similar_texts_and_leaves_others(spark):
    rng = random.Random(12)
    texts, near = {k: prose(rng, 200) for k in range(60)}, {}
    for k in range(30):
        words = texts[k].split()
        for at in rng.sample(range(len(words)), 4):  # about 0.82 over five-word shingles
            words[at] = "changed"
        near[100 + k] = " ".join(words)
    half = {200 + k: " ".join(texts[40 + k].split()[:100]) + " " + prose(rng, 100) for k in range(10)}
    rows = [*texts.items(), *near.items(), *half.items(), (300, texts[7]), (301, near[107]), (302, None), (303, ""), (304, "one")]
    left = {r["doc_id"] for r in keep_one(documents(spark, rows)).collect()}
    assert set(texts) | set(half) | {302, 304} <= left and not left & {300, 301, 303}
    similar = [k for k in near if len(set(shingles(near[k], 5)) & set(shingles(texts[k - 100], 5))) >= 0.8 * len(set(shingles(near[k], 5)) | set(shingles(texts[k - 100], 5)))]
    assert len(similar) > 15 and sum(k in left for k in similar) <= 0.1 * len(similar) and set(near) - set(similar) <= left
    apart = [int(np.bitwise_count(wide_fingerprint(shingle_set(texts[k])) ^ wide_fingerprint(shingle_set(texts[k + 1]))).sum()) for k in range(50)]
    assert min(apart) > 1.5 * ACCEPT and keep_one(documents(spark, [])).count() == 0


def test_a_large_group_of_near_copies_is_compared_in_rows_that_grow_with_it(spark, monkeypatch):
    from wordloom.llm import simhash

    rng = random.Random(21)
    texts = []
    base = [prose(rng, 150).split() for _ in range(9)]
    # Near copies of one text that differ in their own places, and fewer of eight others: they meet under many keys.
    for k in range(400):
        words = list(base[0] if k % 2 else base[1 + k // 2 % 8])
        for at in rng.sample(range(150), rng.randrange(3)):
            words[at] = f"w{rng.random()}"
        texts.append(" ".join(words))
    texts = sorted(set(texts))
    hashes = [shingle_set(t) for t in texts]
    nodes = spark.createDataFrame([(k, *wide_fingerprint(h).view(np.int64).tolist()) for k, h in enumerate(hashes)], "id long, " + ", ".join(f"w{k} long" for k in range(6))).repartition(3)
    table = spark.createDataFrame([(k, bytearray((h >> np.uint64(32)).astype("<u4").tobytes())) for k, h in enumerate(hashes)], "id long, shingles binary")
    made, stage, compared = {}, simhash.staged, simhash._similar_runs

    def counted(df, name, *more):
        out = stage(df, name, *more)
        made[name] = out.count()
        return out

    def counted_rows(laid, sets):
        made.setdefault("compared", []).append(laid.count())
        return compared(laid, sets)

    monkeypatch.setattr(simhash, "staged", counted)
    monkeypatch.setattr(simhash, "_similar_runs", counted_rows)
    monkeypatch.setattr(simhash, "PIVOTS", 10)
    results = []
    for size in (32 << 20, 16_000):
        monkeypatch.setattr(simhash, "SET_BYTES", size)
        made.clear()
        label = {r["node"]: r["component"] for r in connected_components(similar_links(nodes, table)).collect()}
        results.append(label)
        assert made["simhash-candidates"] <= len(texts)
        blocks = 4 * sum(map(len, hashes)) // size + 1
        # A row once, the pivots in each block; what is linked through them isn't compared again.
        assert made["compared"][0] <= len(texts) + 60 * blocks * (blocks > 1) and sum(made["compared"][1:]) <= 10 * blocks
    assert results[0] == results[1] and len(set(results[0].values())) == 9
