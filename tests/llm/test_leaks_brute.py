"""Template decontamination against every position of every document, and WARC derivatives read back byte by byte."""

import base64
import hashlib
import random
import re
from collections import defaultdict

import pytest

from tests.llm._rows import documents
from wordloom.llm import decontamination as D
from wordloom.llm import warc

NAMES, UNITS, PLAIN = ["Anna", "Peter", "Maria", "Paris"], ["km", "days", "percent"], ["the", "of", "runs", "apples", "sold", "to", "with", "tree", "left"]


def phrase(rng, n):
    out = []
    while len(out) < n:
        kind = rng.random()
        if kind < 0.12:
            out += [str(rng.randint(1, 99)), rng.choice(UNITS)]
        elif kind < 0.3:
            out.append(rng.choice(NAMES))
        else:
            out.append(rng.choice(PLAIN) + ("." if rng.random() < 0.05 else ""))
    return out[:n]


def changed(rng, words):
    """The same question with other names and numbers, sometimes with one swapped, in capitals or with a word lost."""
    names = dict(zip(NAMES, rng.sample(NAMES, len(NAMES))))
    out = [names.get(w, str(int(w) + 7) if w.isdigit() else w) for w in words]
    if rng.random() < 0.3:
        out[rng.randrange(len(out))] = rng.choice(NAMES)
    if rng.random() < 0.3:
        del out[rng.randrange(len(out))]
    return [w.upper() for w in words] if rng.random() < 0.2 else out


def tokens(text):
    _, kind, hashed, value = D.template([text])
    return list(zip(kind.tolist(), hashed.tolist(), value.tolist()))


def brute(docs, items, width=D.WINDOW, threshold=D.THRESHOLD):
    want = {}
    for item, item_text in items:
        it = tokens(item_text)
        w = min(width, len(it))
        if w < D.LITERALS:
            continue
        windows = range(len(it) - w + 1)
        templates = {p for p in windows if sum(k == 0 for k, *_ in it[p : p + w]) >= min(D.LITERALS, w)}
        for doc, text in docs:
            dt = tokens(text)
            lines = defaultdict(lambda: (set(), set()))
            for q in range(len(dt) - w + 1):
                for p in windows:
                    a, b = it[p : p + w], dt[q : q + w]
                    at, slots = lines[q - p]
                    if [v for *_, v in a] == [v for *_, v in b]:
                        at.add((True, p))
                    if p in templates and sum(k == 0 for k, *_ in b) >= min(D.LITERALS, w) and [h for _, h, _ in a] == [h for _, h, _ in b]:
                        at.add((False, p))
                        slots.update((x[2], y[2]) for x, y in zip(a, b) if x[0] != 0)
            found, most = set(), 0
            for at, slots in lines.values():
                if at and len({x for x, _ in slots}) == len(slots) == len({y for _, y in slots}):
                    found |= at
                    most = max(most, len(slots))
            share = max(sum(1 for plain, _ in found if plain) / len(windows), sum(1 for plain, _ in found if not plain) / len(templates) if templates else 0)
            if share >= threshold:
                want[(doc, item)] = (round(share, 9), most)
    return want


@pytest.mark.parametrize("seed", range(3))
def test_leaks_at_every_position(spark, seed):
    rng = random.Random(seed)
    items = [(i, phrase(rng, rng.choice([3, 4, 5, 8, 15, 25]))) for i in range(12)]
    docs = []
    for d in range(40):
        words = phrase(rng, rng.randint(0, 40))
        for _ in range(rng.randrange(3)):
            words = words + changed(rng, rng.choice(items)[1]) + phrase(rng, 5)
        docs.append((d, " ".join(words)))
    bench = [(i, " ".join(w)) for i, w in items]
    got = D.matches(documents(spark, docs).repartition(3), spark.createDataFrame(bench, "item_id long, text string"))
    want = brute(docs, bench)
    assert {(r["doc_id"], r["item_id"]): (round(r["coverage"], 9), r["n_slots"]) for r in got.collect()} == want and len(want) > 20


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_derivatives_as_bytes(spark):
    """Each record is read back from its bytes alone and held against the response it refers to."""
    rng = random.Random(2)
    pages = [(i, f"http://h{i % 3}.net/{i}", f"<html><body><article><p>{' '.join(rng.choice(PLAIN) for _ in range(30))} {i}</p></article></body></html>") for i in range(15)]
    pages += [(15, None, None), (16, "http://x.net", ""), (3, pages[3][1], pages[3][2]), (17, "http://long.net", "<p>" + "word " * 200_000)]
    frame = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, block string, record_type int")
    responses = {}
    for r in warc.as_responses(frame).collect():
        responses.setdefault(r["record_id"], bytes(r["block"]))
    seen = defaultdict(int)
    for r in warc.serialize(warc.derivatives(warc.as_responses(frame))).collect():
        head, _, rest = bytes(r["warc"]).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        size = int(fields["Content-Length"])
        block, end = rest[:size], rest[size:]
        assert lines[0] == "WARC/1.1" and end == b"\r\n\r\n" and fields["WARC-Block-Digest"] == sha1(block)
        source = responses[fields["WARC-Refers-To"]]
        header, _, body = source.partition(b"\r\n\r\n")
        if fields["WARC-Type"] == "metadata":
            told = dict(x.split(": ", 1) for x in block.decode().strip("\r\n").split("\r\n"))
            assert told["source-block-digest"] == sha1(source) and told["source-payload-digest"] == sha1(body) and told["source-length"] == str(len(source))
            assert told["status"] == header.decode().split("\r\n")[0] and told["http-header-content-type"] == "text/html; charset=utf-8"
        else:
            assert fields["WARC-Payload-Digest"] == sha1(block) and block.decode().split() == re.sub(rb"<[^>]*>", b" ", body).decode().split()
        seen[(fields["WARC-Refers-To"], fields["WARC-Type"])] += 1
    assert len(seen) == 2 * len(responses) and sum(seen.values()) == 2 * len(pages)
