"""Scoring, URL rules, HTML blocks, WARC derivatives, decontamination and resharding."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm._rows import awkward, documents, prose
from wordloom.llm import decontamination, htmlblocks, resharding, suffix_tree, urlrules, warc

# --- suffix tree ------------------------------------------------------------------------------------------------------


def test_scores_against_brute_force(spark):
    rng = random.Random(0)
    rows = awkward(6, 500) + [(100 + k, prose(rng, 30)) for k in range(60)] + [(100, "Repeated ROW the")]
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    words = lambda t: (t or "").encode().lower().split()
    c = Counter(w for d, t in rows if not held(d) for w in [*words(t), b""])
    n, v = sum(c.values()), len(c)
    got = suffix_tree.score(documents(spark, rows).repartition(3)).collect()
    want = sorted((d, held(d), len(words(t)) + 1, sum(c[w] > 0 for w in [*words(t), b""]), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*words(t), b""]), 6)) for d, t in rows)
    assert sorted((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    assert suffix_tree.score(documents(spark, [])).count() == 0


def test_tree_follows_longest_suffix_and_sums_to_one():
    rng = random.Random(1)
    nodes = {(0, 0): ([97, 98, 10], [5, 4, 1])}
    for _ in range(12):
        d = rng.randint(1, 3)
        nodes[d, int.from_bytes(bytes(rng.choice([97, 98, 10]) for _ in range(d)), "big")] = ([97, 98], [rng.randint(1, 9), rng.randint(1, 9)])
    tree = suffix_tree.Tree(3, nodes, 1.0)

    def row(ctx):
        if not ctx:
            base = {b: 1 / 256 for b in range(256)}
        else:
            base = row(ctx[1:])
        key = (len(ctx), int.from_bytes(ctx, "big"))
        if key not in nodes:
            return base
        own = dict(zip(*nodes[key]))
        s = sum(own.values())
        return {b: (own.get(b, 0) + base[b]) / (s + 1) for b in range(256)}

    line = bytes(rng.choice([97, 98, 99]) for _ in range(1500))
    full, total = b"\n\n\n" + line + b"\n", 0.0
    for i in range(3, len(full)):
        dist = row(full[i - 3 : i])
        assert abs(sum(dist.values()) - 1) < 1e-9
        total += math.log10(dist[full[i]])
    assert abs(tree.score([line])[0] - total) < 1e-2


def test_contexts_help_on_held_out_texts(spark):
    """Held-out texts are likelier under the tree than under its root alone; the margin over the unigram base depends on the corpus (README)."""
    rng = random.Random(2)
    docs = documents(spark, [(k, prose(rng, 120)) for k in range(200)])
    tree = suffix_tree.grow(suffix_tree.window_counts(docs, 5))
    root = suffix_tree.grow(suffix_tree.window_counts(docs, 0), 0)
    lines = [b" ".join(suffix_tree.token_list(prose(rng, 120))) for _ in range(20)]
    assert tree.states > 50 and tree.score(lines).sum() > 0.8 * root.score(lines).sum()


# --- URL rules --------------------------------------------------------------------------------------------------------


def slow_match(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut].lower(), rest[cut:]
    path = tail.split("?")[0].split("#")[0]
    fit = [(len(h), len(p), v == "block", f"{h}{p}", v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


@pytest.mark.parametrize("rules", [urlrules.RULES, [("block", "a.b", ""), ("allow", "b", "/x"), ("block", "x.a.b", "/x/y"), ("allow", "a.b", "/"), ("block", "c", "/"), ("allow", "c", "/")], []])
def test_rules_against_brute_force(spark, rules):
    rng = random.Random(0)
    hosts = ["net", "example.net", "www.EXAMPLE.net", "example.com", "badexample.com", "org", "x.org", "a.b", "x.a.b", "xa.b", "b", "c", "c.c", "netx", "a-net"]
    urls = [None, "", "no scheme", "http://", "http://net", "http://net?/", "a://b://c/d", "http://a.b/x\ny", "http://.net/"]
    urls += [f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/en/1', '/de/2?x=/en/', '/x', '/x/y/z#q', '?/x'])}" for _ in range(300)]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string").repartition(4)
    got = {r["page_id"]: tuple(r)[1:] for r in urlrules.match(pages, urlrules.rule_table(spark, rules)).collect()}
    for i, u in enumerate(urls):
        assert got[i] == slow_match(u, rules), u
    assert urlrules.match(pages.limit(0), urlrules.rule_table(spark, rules)).count() == 0


# --- HTML -------------------------------------------------------------------------------------------------------------


def test_tree_fits_its_table():
    x, y = htmlblocks.labelled_table()
    assert (htmlblocks.decide(htmlblocks.trained_tree(), x) == y).all()


def test_main_text():
    page = """<html><head><title>no</title><style>p{}</style></head><body><div class="cookie-notice"><p>We use cookies a lot here</p></div><nav><ul><li><a href=/>Home</a></ul></nav>
    <script>var t="</p>";</script><!-- <p>no</p> --><article><h1>Head &amp; tail</h1><p>One&nbsp;two\n three<br>four <b>bold</b>ed &#233;</p><p>Ok.<p>Unclosed <a href=x>link</a> text
    <form><p>Your mail</p><input><button>Send</button></form><section class="comments"><p>A reader says something long enough to look like text of the page</p></section></article>
    <aside><p>Other story</p></aside><footer>&copy; all</footer>"""
    assert htmlblocks.main_text(page) == "Head & tail\nOne two three four bolded é\nOk.\nUnclosed link text"
    assert htmlblocks.main_text('<html class="js menu"><body class="post has-sidebar no-comments"><nav>Home</nav><article><p>One two three four.</p></article><p class="footer">End</p></body></html>') == "One two three four."
    assert htmlblocks.main_text(None) == "" and htmlblocks.main_text("") == "" and htmlblocks.main_text("<p") == ""


def test_extract_rows(spark):
    big = "<article><p>" + "word " * 50_000 + "</p></article>"
    pages = spark.createDataFrame([(1, "u", None, "t"), (2, None, big, "t"), (2, None, big, "t")], "page_id long, url string, html string, text string")
    got = sorted((r["page_id"], r["n_chars"]) for r in htmlblocks.extract(pages).collect())
    assert got == [(1, 0), (2, 249_999), (2, 249_999)] and htmlblocks.extract(pages.limit(0)).count() == 0


# --- WARC -------------------------------------------------------------------------------------------------------------


def test_derivatives_refer_to_their_response(spark):
    pages = spark.createDataFrame([(1, "http://a/", "<article><p>Hello there</p></article>"), (2, None, None)], "page_id long, url string, html string")
    responses = warc.as_responses(pages)
    source = {r["source_id"]: r for r in responses.collect()}
    got = warc.derivatives(responses.unionByName(responses.withColumn("record_type", F.lit("request")))).collect()
    assert sorted((r["source_id"], r["record_type"]) for r in got) == [(1, "conversion"), (1, "metadata"), (2, "conversion"), (2, "metadata")]
    assert len({r["record_id"] for r in got}) == 4
    for r in got:
        s = source[r["source_id"]]
        assert r["refers_to"] == s["record_id"] and r["target_uri"] == s["target_uri"] and r["content_length"] == len(r["block"]) and r["block_digest"] == warc.digest(bytes(r["block"]))
    meta = next(bytes(r["block"]).decode() for r in got if r["source_id"] == 1 and r["record_type"] == "metadata")
    assert f"source-block-digest: {warc.digest(bytes(source[1]['block']))}" in meta and "http-header-content-type: text/html; charset=utf-8" in meta
    assert next(bytes(r["block"]) for r in got if r["source_id"] == 1 and r["record_type"] == "conversion") == b"Hello there"
    text = bytes(warc.serialize(warc.derivatives(responses)).where("source_id = 1 and record_type = 'conversion'").first()["warc"])
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: conversion\r\n") and text.endswith(b"\r\n\r\nHello there\r\n\r\n")
    assert warc.derivatives(responses.limit(0)).count() == 0


# --- decontamination --------------------------------------------------------------------------------------------------


def test_leaks_and_parameters(spark, monkeypatch):
    rng = random.Random(5)
    item = "If Anna has 12 apples and gives Peter 5 apples how many apples does Anna have left after the trade of the day"
    other = prose(rng, 40).replace("ß", "s")
    bench = spark.createDataFrame([(1, item, "z"), (2, other, "z"), (3, None, "z"), (4, "too short", "z"), (5, "just four plain words", "z")], "item_id long, text string, h string")
    rows = [
        (1, prose(rng, 80) + " " + item.replace("12", "31").replace("Anna", "Maria").replace("Peter", "John") + ". " + prose(rng, 20)),
        (2, item.replace("Anna has", "Eva has")),  # two values for one slot
        (3, prose(rng, 30) + "\n" + other.upper() + "\n" + prose(rng, 30)),
        (4, " ".join(other.split()[:20])), (5, None), (6, ""), (7, prose(rng, 4000)), (8, "Just four plain words!"), (8, "Just four plain words!"),
    ]
    docs = documents(spark, rows).repartition(3)
    for limit in (1 << 21, 0):
        monkeypatch.setattr(decontamination, "FILTER_LIMIT", limit)
        got = {r["doc_id"]: (r["item_ids"], r["n_slots"]) for r in decontamination.contaminated(docs, bench).collect()}
        assert got[1][0] == [1] and got[1][1] >= 3 and got[3][0] == [2] and got[8][0] == [5] and set(got) == {1, 3, 8}
    assert {r["doc_id"] for r in decontamination.clean(docs, bench).collect()} == {2, 4, 5, 6, 7}
    assert decontamination.contaminated(docs.limit(0), bench).count() == 0 and decontamination.contaminated(docs, bench.limit(0)).count() == 0


# --- resharding -------------------------------------------------------------------------------------------------------


def test_flow_moves_as_little_as_possible():
    rng = random.Random(0)
    for _ in range(60):
        n, m = rng.randint(1, 5), rng.randint(1, 6)
        old = [rng.randint(0, 50) for _ in range(n)]
        total = sum(old)
        cap = [total // m + 1 + rng.randint(0, 9) for _ in range(m)]
        flow = resharding.min_cost_flow(old, cap)
        assert [sum(r) for r in flow] == old and all(sum(r[j] for r in flow) <= cap[j] for j in range(m)) and min(map(min, flow)) >= 0
        stay = sum(flow[i][i] for i in range(min(n, m)))
        assert stay == sum(min(old[i], cap[i]) for i in range(min(n, m)))
    with pytest.raises(ValueError):
        resharding.min_cost_flow([5], [4])


def test_plan_and_rewrite(spark, tmp_path):
    rng = random.Random(1)
    rows = awkward(2, 300) + [(1000 + k, prose(rng, rng.randint(1, 60))) for k in range(900)] + [(5000 + k, "hot text " * 9) for k in range(500)]
    docs = documents(spark, rows).repartition(5)
    got = resharding.plan(docs).toPandas()
    assert len(got) == len(rows)
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 16 and sizes.max() <= 1.3 * sizes.mean()
    for _, g in got.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    want = sorted((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert sorted(map(tuple, got[["doc_id", "size", "text_crc32"]].to_numpy().tolist())) == want
    assert resharding.plan(documents(spark, [])).count() == 0
    few = documents(spark, rows[20:600], extra=False)
    placed = resharding.plan(few, old_shards=3, new_shards=4, buckets=64)
    few.join(placed.select("doc_id", F.col("old_shard").alias("shard")), "doc_id").write.partitionBy("shard").parquet(str(tmp_path / "old"))
    changed = resharding.rewrite(spark, str(tmp_path / "old"), str(tmp_path / "new"), placed)
    new = {(r["doc_id"], r["shard"]) for r in spark.read.parquet(str(tmp_path / "new")).select("doc_id", "shard").collect()}
    assert new == {(r["doc_id"], r["shard"]) for r in placed.collect() if r["shard"] in changed}


def test_equal_texts_share_a_shard_unless_they_fill_much_of_one(spark):
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(20, 40)) for _ in range(150)]
    rows = [(k, texts[k % 150]) for k in range(400)]
    shards = {}
    for r in resharding.plan(documents(spark, rows)).collect():
        shards.setdefault(dict(rows)[r["doc_id"]], set()).add(r["shard"])
    assert max(map(len, shards.values())) == 1
    hot = [(k, "the same text of some length " * 3) for k in range(300)] + [(1000 + k, prose(rng, 20)) for k in range(600)]
    sizes = resharding.plan(documents(spark, hot)).groupBy("shard").agg({"size": "sum"}).toPandas()["sum(size)"]
    assert len(sizes) == 16 and sizes.max() < 1.1 * sizes.mean()


@pytest.mark.parametrize("bad", ('<p "', "<a", "<li></x>", '<p "> "', "<!", "<p '\">\"", "<", "<script>", "<div>", "&#1", "</script "))
def test_broken_pages_take_time_in_proportion(bad):
    import time

    from wordloom.llm.htmlblocks import main_text

    began = time.process_time()
    main_text(bad * (1_000_000 // len(bad)))
    main_text(bad * (1_000_000 // len(bad)) + "'>")
    assert time.process_time() - began < 20


def test_where_tags_end():
    from wordloom.llm.htmlblocks import blocks

    texts = lambda page: [b[0] for b in blocks(page)]
    assert texts("<p title='a > b'>one</p><p class=\"x>two</p>") == ["one", "two"]
    assert texts("a < b <p>c<!-- <p>d --> e<!doctype x><![CDATA[ f ]]>g<p>h <ul") == ["a < b", "c eg", "h"]
    assert texts("<script>if (a < b) '</p>'</script >x<style>y") == ["x"]
