"""SimHash near-duplicates by the generalised pigeonhole principle.

1. A fingerprint of 64 bits for each text, from the XXH64 of its word shingles.
2. Equal fingerprints are one node; only distinct ones go on.
3. Bits are grouped: those that vary together go into one part, so that a part's frequent values gather in
   few parts. The 64 x 64 table of joint counts is summed by Spark.
4. Two fingerprints within ``radius`` bits differ, for any thresholds T with sum(T) = radius - parts + 1, by T[i] bits or fewer in
   some part i (-1: the part isn't probed). Each fingerprint gets its own thresholds by a dynamic program over the parts that
   minimises its estimated candidates, from counts of the parts' values (at most 2^16 for each slice of a part).
5. Every fingerprint is indexed under its value of each part and probes all values within T[i]. Rows with one key
   meet in one sorted run and are verified by their full distance. A run leaves a spanning forest of its
   links, never all pairs; keys with more than ``HOT`` rows are split into pairs of blocks.
6. Components of the links, then the smallest doc_id of each.

``keep_one`` also takes a Jaccard similarity of 0.8 or more over distinct five-word shingles: too far for one word of 64 bits, so a text gets
``WORDS`` independent ones from the same hashes. Each word is searched as above; rows that meet and lie within ``ACCEPT`` of all
384 bits are candidates only (58 bits are expected at 0.8, ``ACCEPT`` is 3.7 standard deviations above). A run hands on a forest of its
candidate links; each component of all of them is one group, whose texts are compared by their whole sets of shingle hashes: no link
stands on fingerprint bits, and groups above ``SET_BYTES`` are split into blocks. Texts that share no candidate component are missed: the
expected recall at a similarity of 0.8 is 0.98 (0.95 beyond 2^24 texts, where parts are wider and probed one bit further), at 0.85 above 0.99.

Rows: a null, empty or blank text has fingerprint 0 and links like any other; repeated rows
keep a row each, and of rows with one id the smallest row number stands for a tie; very long texts are read whole; an empty table gives an empty result;
other columns are ignored, and passed on by ``keep_one``, whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm._shared import discarded, keyed, local_components, staged, star_edges, text_batches, utf8
from wordloom.llm.graph import connected_components

RADIUS, SHINGLE, SEED = 3, 3, 42
#: For the similarity of whole texts: words of 64 bits, a candidate's distance over all, words in a shingle.
WORDS, ACCEPT, SIMILAR_SHINGLE = 6, 84, 5
#: The Jaccard similarity that links, as a fraction.
SIMILAR = (4, 5)
#: Shingle hashes that one task compares at once.
SET_BYTES = 32 << 20
#: Rows of a group of several blocks that are compared in each of them, about.
PIVOTS = 64
#: Rows of one key that are compared in one task; more are split into pairs of blocks.
HOT = 30_000
#: What a probe costs, in verified candidates.
PROBE_COST = 4.0
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def shingles(text: str | None, width: int = SHINGLE) -> list[bytes]:
    words = utf8(text).translate(_LOWER).split()
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = ends - np.fromiter(map(len, words), dtype=np.int64, count=len(words)) - 1
    return [line[i:j] for i, j in zip(starts[: len(words) - width + 1].tolist(), (ends[width - 1 :] - 1).tolist())]


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    parts = shingles(text, width)
    if not parts:
        return 0
    digest = xxhash.xxh64_intdigest
    octets = np.array([digest(s, SEED) for s in parts], dtype="<u8").view(np.uint8).reshape(-1, 8)
    value = 0
    for k in range(8):
        ones = np.bincount(octets[:, k], minlength=256) @ _BITS
        value |= sum(1 << (8 * k + b) for b in range(8) if 2 * ones[b] > len(parts))
    return value


def fingerprints(docs: DataFrame, width: int = SHINGLE, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, fp (the 64 bits as a long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_batches(batch):
                rows = batch.slice(lo, hi - lo)
                fps = np.array([fingerprint(t, width) for t in rows.column(1).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id long, fp long")


def shingle_set(text: str | None, width: int = SIMILAR_SHINGLE) -> np.ndarray:
    """The distinct hashes of the shingles, sorted."""
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(s, SEED) for s in shingles(text, width)], dtype=np.uint64))


def wide_fingerprint(hashes: np.ndarray, words: int = WORDS) -> np.ndarray:
    """``words`` fingerprints of 64 bits over distinct hashes."""
    out = np.zeros(words, dtype=np.uint64)
    for w in range(words):
        spread = hashes + np.uint64((w + 1) * 0x9E3779B97F4A7C15 % 2**64)
        spread = (spread ^ (spread >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        spread = (spread ^ (spread >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        octets = (spread ^ (spread >> np.uint64(31))).view(np.uint8).reshape(-1, 8)
        ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)])
        out[w] = np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0]
    return out


def wide_fingerprints(docs: DataFrame, words: int = WORDS, width: int = SIMILAR_SHINGLE, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, w0, w1, ..., shingles (sorted, the upper 32 bits of each hash): only texts with a word."""
    names = ["doc_id", *(f"w{k}" for k in range(words)), "shingles"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_batches(batch):
                rows = batch.slice(lo, hi - lo)
                sets = [shingle_set(t, width) for t in rows.column(1).to_pylist()]
                full = [k for k, hashes in enumerate(sets) if len(hashes)]
                if full:
                    table = np.stack([wide_fingerprint(sets[k], words) for k in full]).view(np.int64)
                    short = pa.array([(sets[k] >> np.uint64(32)).astype("<u4").tobytes() for k in full], pa.binary())
                    yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(full)), *(pa.array(np.ascontiguousarray(c)) for c in table.T), short], names=names)

    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return plain.mapInArrow(run, ", ".join(f"{c} long" for c in names[:-1]) + ", shingles binary")


def joint_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how often bits i and j are both set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((64, 64)), 0
        for batch in batches:
            fps = np.ascontiguousarray(batch.column(0).to_numpy())
            bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            n += len(fps)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(4097)), pa.array(np.append(total.ravel(), n).astype(np.int64))], names=["i", "n"])

    table = np.zeros(4097)
    for r in nodes.select("fp").mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        table[r["i"]] = r["n"]
    return int(table[4096]), table[:4096].reshape(64, 64)


def group_bits(n: int, joint: np.ndarray, widths: list[int]) -> list[list[int]]:
    """Parts of the given widths; each grows from the bit with the strongest ties left, by the strongest mean tie."""
    if n == 0:
        joint, n = np.zeros((64, 64)), 1
    p = np.diag(joint) / n
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    tie = np.abs((joint / n - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(tie, 0)
    left, parts = set(range(64)), []
    for width in widths:
        rest = sorted(left)
        part = [max(rest, key=lambda b: (tie[b, rest].sum(), -b))]
        while len(part) < width:
            rest = sorted(left - set(part))
            part.append(max(rest, key=lambda b: (tie[b, part].sum(), -b)))
        left -= set(part)
        parts.append(part)
    return parts


def choose_widths(n: int) -> list[int]:
    """More fingerprints take fewer and wider parts, so that a probe still meets few candidates."""
    if n <= 1 << 21:
        return [16] * 4
    return [22, 21, 21] if n <= 1 << 26 else [32, 32]


def similar_layout(n: int) -> tuple[list[int], int]:
    """Parts of one word and the searched radius when whole texts are compared by several words: equal parts, or 21 bits but for one."""
    return ([13, 13, 13, 13, 12], 4) if n <= 1 << 24 else ([22, 21, 21], 5)


def part_values(fps: np.ndarray, parts: list[list[int]]) -> list[np.ndarray]:
    fps = fps.view(np.uint64)
    out = []
    for part in parts:
        value = np.zeros(len(fps), dtype=np.uint64)
        for k, bit in enumerate(part):
            value |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)
        out.append(value)
    return out


def _slices(width: int) -> list[tuple[int, int]]:
    """Shift and width of the slices of at most 16 bits for which values are counted."""
    n = -(-width // 16)
    return [(width * k // n, width * (k + 1) // n - width * k // n) for k in range(n)]


def value_counts(nodes: DataFrame, parts: list[list[int]]) -> list[list[np.ndarray]]:
    """Counts of the values of each slice of each part: at most 2^16 rows for a slice."""
    cuts = [(i, s, w) for i, part in enumerate(parts) for s, w in _slices(len(part))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros(1 << w, dtype=np.int64) for _, _, w in cuts]
        for batch in batches:
            values = part_values(np.ascontiguousarray(batch.column(0).to_numpy()), parts)
            for table, (i, s, w) in zip(tables, cuts):
                table += np.bincount(((values[i] >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64), minlength=1 << w)
        for c, table in enumerate(tables):
            full = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array(full + (c << 16)), pa.array(table[full])], names=["v", "n"])

    counts = [np.zeros(1 << w, dtype=np.int64) for _, _, w in cuts]
    found = nodes.select("fp").mapInArrow(run, "v long, n long").groupBy("v").agg(F.sum("n").alias("n")).toArrow()
    v, n = found.column("v").to_numpy(), found.column("n").to_numpy()
    for c in range(len(cuts)):
        mine = v >> 16 == c
        counts[c][v[mine] & 0xFFFF] = n[mine]
    grouped = iter(counts)
    return [[next(grouped) for _ in _slices(len(part))] for part in parts]


def ball(width: int, radius: int) -> np.ndarray:
    """All masks of at most ``radius`` bits; -1: none."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in itertools.combinations(range(width), r)]
    return np.array(masks, dtype=np.uint64)


class Estimator:
    """Expected rows within 0, 1 or 2 bits of a part's value; slices count as independent."""

    def __init__(self, n: int, parts: list[list[int]], counts: list[list[np.ndarray]]):
        self.n, self.parts = max(n, 1), parts
        self.rings = []
        for part, tables in zip(parts, counts):
            rings = []
            for (_, w), table in zip(_slices(len(part)), tables):
                near = sum(table[np.arange(1 << w) ^ (1 << b)] for b in range(w))
                nearer = sum(near[np.arange(1 << w) ^ (1 << b)] for b in range(w))
                rings.append((table / self.n, near / self.n, (nearer - w * table) / 2 / self.n))
            self.rings.append(rings)

    def within(self, i: int, values: np.ndarray) -> np.ndarray:
        """(3, rows): expected rows of part ``i`` within 0, 1 and 2 bits."""
        exact = [np.ones(len(values)), np.zeros(len(values)), np.zeros(len(values))]
        for (s, w), rings in zip(_slices(len(self.parts[i])), self.rings[i]):
            at = ((values >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64)
            r = [ring[at] for ring in rings]
            exact = [sum(exact[k] * r[d - k] for k in range(d + 1)) for d in range(3)]
        return np.cumsum(exact, axis=0) * self.n


def allocate(costs: np.ndarray, budget: int) -> np.ndarray:
    """Thresholds of each row. costs (parts, 4, rows): of thresholds -1, 0, 1, 2; they sum to ``budget``."""
    parts, options, n = costs.shape
    low, high = -parts, 2 * parts
    best = np.full((high - low + 1, n), np.inf)
    best[-low] = 0
    picked = np.zeros((parts, high - low + 1, n), dtype=np.int8)
    for i in range(parts):
        new = np.full_like(best, np.inf)
        for o in range(options):
            t = o - 1
            for s in range(low, high + 1):
                if low <= s - t <= high:
                    c = best[s - t - low] + costs[i, o]
                    better = c < new[s - low]
                    new[s - low][better] = c[better]
                    picked[i, s - low][better] = t
        best = new
    out, at = np.zeros((parts, n), dtype=np.int64), np.full(n, budget - low)
    for i in range(parts - 1, -1, -1):
        out[i] = picked[i, at, np.arange(n)]
        at = at - out[i]
    return out


def _keyed(nodes: DataFrame, parts: list[list[int]], counts: list[list[np.ndarray]], n: int, radius: int, carry: tuple[str, ...] = ("fp",)) -> DataFrame:
    """key, block and the columns ``carry``: where each fingerprint is indexed or probes."""
    shared = nodes.sparkSession.sparkContext.broadcast((parts, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, counts = shared.value
        estimate = Estimator(n, parts, counts)
        balls = [[ball(len(p), t) for t in range(3)] for p in parts]
        sizes = np.array([[0, *(len(b) for b in bs)] for bs in balls], dtype=float)
        for batch in batches:
            fps = np.ascontiguousarray(batch.column("fp").to_numpy())
            values = part_values(fps, parts)
            near = [estimate.within(i, v) for i, v in enumerate(values)]
            costs = np.stack([np.vstack([np.zeros(len(fps)), e]) for e in near]) + PROBE_COST * sizes[:, :, None]
            chosen = allocate(costs, radius - len(parts) + 1)
            keys, who, rows_at = [], [], []
            for i, v in enumerate(values):
                for t in (-1, 0, 1, 2):
                    of = np.flatnonzero(chosen[i] == t)
                    masks = balls[i][max(t, 0)]  # the value itself is the index entry, probed or not
                    keys.append(((v[of][:, None] ^ masks) | np.uint64(i << 40)).ravel().view(np.int64))
                    who.append(np.repeat(of, len(masks)))
                    rows_at.append(np.repeat(near[i][0][of], len(masks)))
            key, of, about = np.concatenate(keys), np.concatenate(who), np.concatenate(rows_at)
            # Every row of a key must find the same number of blocks: the estimate for the key's own value.
            for i in range(len(parts)):
                mine = key >> 40 == i
                about[mine] = estimate.within(i, (key[mine] & ((1 << 40) - 1)).view(np.uint64))[0]
            blocks = np.maximum(1, np.ceil(2 * about / HOT)).astype(np.int64)
            block = (fps.view(np.uint64)[of] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % blocks
            row = np.repeat(np.arange(len(key)), blocks)
            other = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            pair = np.minimum(block[row], other) * (1 << 20) + np.maximum(block[row], other)
            taken = pa.array(of[row])
            yield pa.RecordBatch.from_arrays([pa.array(key[row]), pa.array(pair), *(batch.column(c).take(taken) for c in carry)], names=["key", "block", *carry])

    return nodes.select("fp", *(c for c in carry if c != "fp")).mapInArrow(run, ", ".join(f"{c} long" for c in ("key", "block", *carry)))


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of rows of one word or of several."""
    bits = np.bitwise_count(a ^ b)
    return bits if bits.ndim == 1 else bits.sum(axis=1)


def _verified(key: np.ndarray, ids: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside each run of equal keys."""
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    sizes = np.diff(np.append(heads, len(key)))
    a, b = [], []
    u = prints.view(np.uint64)
    small = np.repeat(sizes <= 48, sizes)
    at = np.flatnonzero(small)
    k = 1
    while len(at):
        at = at[at + k < len(key)]
        at = at[key[at] == key[at + k]]
        link = at[_distance(u[at], u[at + k]) <= radius]
        a.append(ids[link])
        b.append(ids[link + k])
        k += 1
    for h, size in zip(heads[sizes > 48].tolist(), sizes[sizes > 48].tolist()):
        rest, group = np.arange(h, h + size), []
        # Breadth first: a row leaves ``rest`` when it's reached, so a dense group of g rows gives g - 1 links.
        while len(rest):
            if not group:
                group, rest = [rest[0]], rest[1:]
            seed = group.pop()
            hit = _distance(u[rest], u[seed]) <= radius
            if hit.any():
                new = rest[hit]
                a.append(np.full(len(new), ids[seed]))
                b.append(ids[new])
                group.extend(new.tolist())
                rest = rest[~hit]
    return (np.concatenate(a), np.concatenate(b)) if a else (ids[:0], ids[:0])


def links(nodes: DataFrame, radius: int = RADIUS, widths: list[int] | None = None) -> DataFrame:
    """a, b: links between distinct fingerprints that connect all that lie within ``radius`` bits."""
    n, joint = joint_counts(nodes)
    parts = group_bits(n, joint, widths or choose_widths(n))
    return _forest(_keyed(nodes, parts, value_counts(nodes, parts), n, radius), "fp", ["fp"], radius)


def candidate_links(nodes: DataFrame, accept: int = ACCEPT) -> DataFrame:
    """a, b: links that connect all rows (id, w0, w1, ...) which meet under a part and lie within ``accept`` bits."""
    names = sorted((c for c in nodes.columns if c != "id"), key=lambda c: int(c[1:]))
    keyed_rows = None
    for k, name in enumerate(names):
        word = nodes.withColumn("fp", F.col(name))
        n, joint = joint_counts(word)
        widths, radius = similar_layout(n)
        parts = group_bits(n, joint, widths)
        some = _keyed(word, parts, value_counts(word, parts), n, radius, ("id", *names)).withColumn("key", F.col("key") + F.lit(k << 43))
        keyed_rows = some if keyed_rows is None else keyed_rows.unionByName(some)
    return _forest(keyed_rows, "id", names, accept)


def similar_within(sets: list[np.ndarray], similar: tuple[int, int] = SIMILAR) -> list[tuple[int, int]]:
    """Positions that link: a spanning forest of all pairs whose Jaccard similarity is at least ``similar``."""
    above, below = similar
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    rest, found, reached = np.arange(len(sets)), [], []
    while len(rest):
        if not reached:
            reached, rest = [int(rest[0])], rest[1:]
        seed = reached.pop()
        near = rest[(above * sizes[rest] <= below * sizes[seed]) & (above * sizes[seed] <= below * sizes[rest])]
        if not len(near):
            continue
        flat, own = np.concatenate([sets[k] for k in near]), sets[seed]
        at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
        both = np.add.reduceat((own[at] == flat).astype(np.int64), np.cumsum(sizes[near]) - sizes[near])
        new = near[below * both >= above * (sizes[near] + sizes[seed] - both)]
        found += [(seed, int(k)) for k in new]
        reached += new.tolist()
        rest = rest[~np.isin(rest, new)]
    return found


def similar_links(nodes: DataFrame, sets: DataFrame, accept: int = ACCEPT) -> DataFrame:
    """a, b: links between ids that connect all candidates of ``nodes`` (id, w0, w1, ...) whose ``sets`` (id, shingles) are similar.

    Candidates of one component are a group, so an id has one row. A group above ``SET_BYTES`` is dealt to blocks, each with some
    ``PIVOTS`` rows of the whole group: what is alike in all blocks links through them. Only the rows that then are outside
    the group's largest component go to all of its blocks, as two rows inside need no link of their own.
    """
    found = connected_components(candidate_links(nodes, accept)).select(F.col("node").alias("id"), F.col("component").alias("grp"))
    member = staged(found.join(sets.select("id", F.length("shingles").cast("long").alias("n")), "id"), "simhash-candidates")
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(F.sum(n) / SET_BYTES)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    groups = member.groupBy("grp").agg(blocks("n").alias("blocks"), F.count("*").alias("rows"))
    laid = staged(member.join(groups, "grp").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")), "simhash-blocks")
    pivot = F.pmod(F.xxhash64("id", F.lit("pivot")), F.greatest(F.ceil(F.col("rows") / PIVOTS), 2 * F.col("blocks"))) == 0
    own = laid.select("grp", F.lit(0).alias("slot"), F.col("own").alias("block"), "id")
    large = laid.where("blocks > 1")
    shared = large.where(pivot).select("grp", F.lit(0).alias("slot"), upto("blocks").alias("block"), "id")
    near = _similar_runs(own.unionByName(shared).distinct(), sets)
    if large.isEmpty():
        return near
    near = staged(near, "simhash-similar-blocks")
    label = connected_components(near.join(large.select(F.col("id").alias("a")), "a", "left_semi")).withColumnRenamed("node", "id")
    named = staged(large.join(label, "id", "left").withColumn("component", F.coalesce("component", "id")), "simhash-labelled")
    most = named.groupBy("grp", "component").agg(F.sum("n").alias("n")).groupBy("grp").agg(F.max(F.struct("n", "component"))["component"].alias("most"))
    rest = named.join(most, "grp").where("component <> most")
    slots = rest.groupBy("grp").agg(blocks("n").alias("slots"))
    asked = rest.join(slots, "grp").select("grp", F.pmod(F.xxhash64("id", F.lit("slot")), F.col("slots")).cast("int").alias("slot"), upto("blocks").alias("block"), "id")
    held = named.join(slots, "grp").select("grp", upto("slots").alias("slot"), F.col("own").alias("block"), "id")
    return near.unionByName(_similar_runs(held.unionByName(asked).distinct(), sets))


def _similar_runs(laid: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: links that connect the similar rows of each grp, slot and block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        now, ids, held = None, [], []

        def settle() -> None:
            pairs = similar_within(held)
            if pairs:
                at = np.array(ids, dtype=np.int64)[np.array(pairs)]
                found.append((at[:, 0], at[:, 1]))

        for batch in batches:
            cols = [batch.column(c) for c in ("grp", "slot", "block", "id", "shingles")]
            for *of, ident, packed in zip(*(c.to_pylist() for c in cols[:4]), cols[4]):
                if of != now:
                    settle()
                    now, ids, held = of, [], []
                    if len(found) > 10_000:
                        found = [star_edges(*(np.concatenate(x) for x in zip(*found)))]
                ids.append(ident)
                held.append(np.unique(np.frombuffer(packed.as_buffer(), dtype="<u4")))
        settle()
        if found:
            a, b = star_edges(*(np.concatenate(x) for x in zip(*found)))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    full = laid.join(sets.select("id", "shingles"), "id").repartition("grp", "slot", "block").sortWithinPartitions("grp", "slot", "block")
    return full.mapInArrow(run, "a long, b long")


def _forest(keyed_rows: DataFrame, ident: str, prints: list[str], radius: int) -> DataFrame:
    """a, b: rows with one key and block meet in one sorted run and are verified."""

    def edges(run_id: np.ndarray, ids: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return star_edges(*_verified(run_id, ids, table, radius))

    return _runs(keyed_rows, ident, prints, edges, star_edges, "a long, b long")


def _runs(keyed_rows: DataFrame, ident: str, prints: list[str], of_runs: Callable, merged: Callable, schema: str) -> DataFrame:
    """What ``of_runs`` (run, id, fingerprints) makes of whole runs of one key and block, two columns; ``merged`` shortens what is held."""
    names = ["key", "block", *dict.fromkeys([ident, *prints])]
    out = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        held = (np.zeros(0, dtype=np.int64),) * len(names)

        def flush(key, block, *columns):
            # Runs of one (key, block): number them so that one comparison tells them apart.
            run_id = np.cumsum(np.append(False, (key[1:] != key[:-1]) | (block[1:] != block[:-1])))
            of = dict(zip(names[2:], columns))
            table = of[prints[0]] if len(prints) == 1 else np.stack([of[c] for c in prints], axis=1)
            e = of_runs(run_id, of[ident], table)
            if len(e[0]):
                found.append(e)

        def emitted():
            a, b = merged(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=out)

        for batch in batches:
            if not batch.num_rows:
                continue
            held = tuple(np.concatenate([h, batch.column(c).to_numpy()]) for c, h in zip(names, held))
            last = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))
            if len(last):
                cut = int(last[-1]) + 1
                flush(*(h[:cut] for h in held))
                held = tuple(h[cut:] for h in held)
            if len(found) > 50:
                yield emitted()
                found = []
        if len(held[0]):
            flush(*held)
        if found:
            yield emitted()

    return keyed_rows.repartition(F.col("key"), F.col("block")).sortWithinPartitions("key", "block").mapInArrow(run, schema)


def near_duplicates(docs: DataFrame, radius: int = RADIUS, width: int = SHINGLE, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable over links)."""
    prints = staged(fingerprints(docs, width, text, key), "simhash")
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    component = connected_components(links(nodes, radius)).withColumnRenamed("node", "fp")
    group = nodes.join(component, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = group.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = group.join(smallest, "component").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def hex16(fp: F.Column) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def groups(docs: DataFrame, radius: int = RADIUS, width: int = SHINGLE, accept: int = ACCEPT, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Near-duplicates by either measure, ``radius`` bits or similar whole texts.

    (doc_id, component_id) by the first measure, then (node, component) that joins those components by the second;
    copies are one row before the second measure starts. Ids are unique.
    """
    spark = docs.sparkSession
    close = staged(near_duplicates(docs, radius, width, text, key).select("doc_id", "component_id"), "simhash-close")
    prints = staged(wide_fingerprints(docs, text=text, key=key), "simhash-wide")
    words = [c for c in prints.columns if c not in ("doc_id", "shingles")]
    # One document stands for all of equal wide fingerprints.
    nodes = staged(prints.groupBy(*words).agg(F.min("doc_id").alias("id")), "simhash-wide-nodes")
    sets = prints.select(F.col("doc_id").alias("id"), "shingles")
    similar = staged(similar_links(nodes, sets, accept), "simhash-similar")
    # A component's id is one of its documents, so documents and components are nodes of one graph; copies are one row in ``held``.
    held = prints.select("doc_id", *words).join(close, "doc_id").select(F.col("component_id").alias("a"), *words).distinct()
    joined = connected_components(held.join(nodes, words).select("a", F.col("id").alias("b")).unionByName(similar))
    discarded(spark, prints)
    return close, joined


def keep_one(docs: DataFrame, radius: int = RADIUS, width: int = SHINGLE, accept: int = ACCEPT, key: str = "doc_id") -> DataFrame:
    """The documents without near-duplicates: of each group one row with the smallest id stays, a null id last."""
    rows, row = keyed(docs)
    close, joined = groups(rows, radius, width, accept, key=row)
    place = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), F.col(row).alias("row"))
    numbered = close.select(F.col("doc_id").alias("number"), "component_id").join(rows.select(F.col(row).alias("number"), place.alias("place")), "number")
    # The first of each component of the first measure, then of the components that the second measure joins.
    first = numbered.groupBy("component_id").agg(F.min("place").alias("place"))
    first = first.join(joined, first["component_id"] == joined["node"], "left").groupBy(F.coalesce("component", "component_id")).agg(F.min("place").alias("place"))
    # The list of rows grows with the table: it is sorted and merged at every size.
    return rows.join(first.select(F.col("place.row").alias(row)).hint("merge"), row, "left_semi").select(*docs.columns)
