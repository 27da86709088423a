"""Profiles of any depth, the state store, decay, counters as maps, ordered sinks: edge cases and plain-Python comparisons."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wordloom.operators import counters, profiles
from wordloom.sources import readers, writers
from wordloom.streaming import streams


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_profiles_of_any_depth(spark):
    chain = [("a", None, ["core"], {"x": 1.0, "y": 1.0})] + [(chr(98 + i), chr(97 + i), [f"m{i}", "core"], {"x": float(i)} if i % 2 else None) for i in range(6)] + [("lone", "unknown", None, None)]
    got = {r["name"]: (r["depth"], r["modules"], r["priority"]) for r in profiles.resolve_profiles(spark.createDataFrame(chain, readers.PROFILE)).collect()}
    assert got["a"] == (0, ["core"], {"x": 1.0, "y": 1.0})
    assert got["g"] == (6, ["core", "m0", "m1", "m2", "m3", "m4", "m5"], {"x": 5.0, "y": 1.0})
    assert got["f"][2] == {"x": 3.0, "y": 1.0} and got["lone"] == (0, [], {})
    for bases in ({"p": "p"}, {"p": "q", "q": "p"}, {"p": "q", "q": "r", "r": "s", "s": "q", "t": None}):
        with pytest.raises(ValueError, match="cycle"):
            profiles.resolve_profiles(spark.createDataFrame([(n, b, ["m"], None) for n, b in bases.items()], readers.PROFILE))


def test_profile_chains_against_plain_python(spark):
    rng = random.Random(2)
    names = [f"p{i:02}" for i in range(40)]
    table = {n: (rng.choice([None, *names[:i]]) if i else None, [rng.choice("abcdefgh") for _ in range(rng.randrange(4))], {rng.choice("uvw"): float(i) for _ in range(rng.randrange(3))}) for i, n in enumerate(names)}
    want = {}
    for n in names:
        path, at = [], n
        while at:
            path.append(at)
            at = table[at][0]
        modules, priority = [], {}
        for p in reversed(path):
            modules += [m for m in dict.fromkeys(table[p][1]) if m not in modules]
            priority |= table[p][2]
        want[n] = (len(path) - 1, modules, priority)
    out = profiles.resolve_profiles(spark.createDataFrame([(n, *v) for n, v in table.items()], readers.PROFILE))
    assert {r["name"]: (r["depth"], r["modules"], r["priority"]) for r in out.collect()} == want


def test_store_survives_replays_and_a_crash_before_the_swap(spark, tmp_path):
    store = streams.word_store(str(tmp_path / "s"))
    delta = lambda *x: spark.createDataFrame(list(x), "lang string, word string, cnt long")
    now = lambda: {(r["lang"], r["word"]): r["cnt"] for r in store.current(spark).collect()}
    assert now() == {} and store.compact(spark) == 0
    store.add(delta(("en", "a", 2), ("en", "b", 1)), 0)
    store.add(delta(("en", "a", 3)), 1)
    store.add(delta(("en", "a", 3)), 1)  # replayed
    want = {("en", "a"): 5, ("en", "b"): 1}
    assert now() == want
    made = store.write_base(spark)  # and a crash
    assert made == (1, 1) and store.version(spark) == (0, -1) and now() == want
    assert store.compact(spark) == 1 and now() == want
    store.add(delta(("en", "a", 3)), 1)  # replayed after the swap
    assert now() == want
    store.add(delta(("fr", "a", 7)), 2)
    assert now() == {**want, ("fr", "a"): 7}
    assert store.compact(spark) == 2 and store.version(spark) == (2, 2)
    assert store.expire(spark) == ["base/version=1", "deltas/version=0", "deltas/version=1"] and now() == {**want, ("fr", "a"): 7}


def test_stream_of_words_with_compaction(spark, tmp_path):
    texts = [("en", f"a b{"xyz"[i % 3]} A") for i in range(20)]
    for i in range(10):
        spark.createDataFrame(texts[2 * i : 2 * i + 2], "lang string, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "d"))
    stream = spark.readStream.schema("lang string, text string").option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "d"))
    streams.incremental_word_counts(stream, str(tmp_path / "t"), str(tmp_path / "c"), compact_every=2).awaitTermination()
    want = Counter(("en", w) for _, t in texts for w in t.lower().split())
    assert {(r["lang"], r["word"]): r["cnt"] for r in streams.current_counts(spark, str(tmp_path / "t")).collect()} == want
    assert streams.word_store(str(tmp_path / "t")).version(spark)[0] == 2


def test_decay_in_batch_on_a_stream_and_by_hand(spark, tmp_path):
    rng = random.Random(4)
    events = [(rng.randrange(3), rng.choice("ab"), 1_700_000_000 + rng.randrange(40 * 86400)) for _ in range(300)]  # in no order
    half, day, keys = 5 * 86400.0, 86400.0, ["user_id", "key"]
    frame = spark.createDataFrame(events, "user_id long, key string, t long").withColumn("ts", F.timestamp_seconds("t"))
    at = float(max(t for *_, t in events))
    want = Counter()
    for u, k, t in events:
        want[(u, k)] += 2 ** ((t - at) / half)
    state = streams.decay_state(frame, keys, half, day)
    read = lambda s: {(r["user_id"], r["key"]): r["uses"] for r in streams.decayed(s, keys, half, at).collect()}
    assert read(state) == pytest.approx(dict(want), rel=1e-9)
    small = streams.folded(state, keys, half, at - 10 * 86400)
    assert read(small) == pytest.approx(dict(want), rel=1e-9) and small.count() < state.count()
    for i in range(6):
        frame.where(F.pmod(F.xxhash64("t"), F.lit(6)) == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "e"))
    store = streams.decay_store(str(tmp_path / "s"), {"user_id": "long", "key": "string"}, ["uses"])
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "e"))
    streams.stream_decay(stream, store, str(tmp_path / "c"), half, day, keys, compact_every=3).awaitTermination()
    assert read(store.current(spark)) == pytest.approx(dict(want), rel=1e-9) and store.version(spark)[0] == 2


def test_counters_are_cut_and_merged(spark):
    rng = random.Random(5)
    data = [(rng.choice(["hot", "hot", "k1", "k2"]), f"v{rng.randrange(60)}", rng.randint(1, 5)) for _ in range(600)]
    frame = spark.createDataFrame(data, "key string, value string, n long")
    want = Counter()
    for k, v, n in data:
        want[(k, v)] += n
    maps = counters.counter_maps(frame, ["key"], most=10)
    sizes = {(r["key"], r["part"]): len(r["counts"]) for r in maps.collect()}
    assert max(sizes.values()) <= 30 and sum(k == "hot" for k, _ in sizes) >= 5
    halves = [counters.counter_maps(frame.where(F.col("n") % 2 == i), ["key"], most=m) for i, m in ((0, 7), (1, 100))]
    got = {(r["key"], r["value"]): r["n"] for r in counters.map_entries(counters.merged_maps(["key"], *halves, most=10), ["key"]).collect()}
    assert got == want


def test_ordered_sinks(spark, tmp_path):
    def lines(path):
        files = sorted(f for f in os.listdir(path) if f.startswith("part-"))
        return [line for f in files for line in open(path / f, encoding="utf-8", newline="\n").read().split("\n")[:-1]]

    words = [f"w{i:03}" for i in range(200)] + ["Ą", "a", "Z", "ﬁ", "😀"]
    random.Random(1).shuffle(words)
    writers.write_wordlist(spark.createDataFrame([(w,) for w in words], "surface string").repartition(5), str(tmp_path / "w"), counts={"all": F.count("*"), "upper": F.count_if(F.col("surface") == "Z")})
    assert lines(tmp_path / "w") == ["# all: 205", "# upper: 1", *sorted(words)]
    data = [(i % 7, f"x{i}", ["p", "q"][: i % 3], None if i % 5 == 0 else float(i)) for i in range(100)] + [(1, 'tab\there "q"', [], 1.0)]
    writers.write_tsv(spark.createDataFrame(data, "k int, name string, tags array<string>, v double").repartition(4), str(tmp_path / "t"), ["name", "k", "tags", "v"], ["k", "name"])
    cell = lambda x: f'"{x.replace(chr(34), chr(34) * 2)}"' if "\t" in x else x
    assert lines(tmp_path / "t") == ["name\tk\ttags\tv", *("\t".join([cell(n), str(k), ";".join(t), "" if v is None else str(v)]) for k, n, t, v in sorted(data, key=lambda r: r[:2]))]
    writers.write_tsv(spark.createDataFrame([], "k int"), str(tmp_path / "e"), ["k"], ["k"])
    assert lines(tmp_path / "e") == ["k"]


def test_shared_folder_needs_a_setting_on_a_cluster():
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda k, d=None: "spark://host:7077" if k == "spark.master" else d)

    with pytest.raises(ValueError):
        writers.shared_folder(Session)
