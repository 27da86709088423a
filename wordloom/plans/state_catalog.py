"""Queries over profiles of any depth, decayed and incremental states, counters as maps, ordered sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wordloom.functions import text as X
from wordloom.operators import counters, profiles
from wordloom.plans.catalog import _USES, _t, _uses
from wordloom.sources import writers
from wordloom.streaming import streams

WEEK, DAY = 7 * 86400.0, 86400.0


def _scratch(spark, name: str) -> str:
    return f"{writers.shared_folder(spark)}/lexicon/{name}-{uuid.uuid4().hex}"


def profile_chain(spark, d):
    """V1: each turn of a conversation is a profile on top of the turn before it."""
    turns = _t(spark, d, "conversations")
    words = F.slice(X.words(F.col("text")), 1, 3)
    value = (F.col("turn") * 10 + F.length("text") % 10).cast("double")
    name = lambda t: F.concat_ws(":", F.col("conv_id").cast("string"), t.cast("string"))
    own = turns.select(name(F.col("turn")).alias("name"), F.when(F.col("turn") > 0, name(F.col("turn") - 1)).alias("base"), words.alias("modules"), F.map_from_entries(F.transform(F.array_distinct(F.transform(words, lambda w: F.substring(w, 1, 1))), lambda k: F.struct(k, value))).alias("priority"))
    out = profiles.resolve_profiles(own)
    priority = F.array_join(F.transform(F.sort_array(F.map_entries("priority")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("long").cast("string"))), " ")
    return out.select("name", "depth", F.array_join("modules", " ").alias("modules"), priority.alias("priority"))


def _marks():
    upper = X.starts_upper(F.col("surface"))
    return {"lower": ~upper, "upper": upper}


def decayed_uses(spark, d):
    """The state of two halves of the events, added up, old days folded, read at the latest time."""
    uses = _uses(spark, d).withColumn("half", F.pmod(F.xxhash64("ts", "user_id"), F.lit(2)))
    keys, marks = ["user_id", "key"], ("lower", "upper")
    store = streams.decay_store("", {"user_id": "long", "key": "string"}, list(marks))
    state = store.merged(*(streams.decay_state(uses.where(F.col("half") == h), keys, WEEK, DAY, marks=_marks()) for h in (0, 1)))
    state = writers.settled(state, "decay")
    at = state.agg(F.max("last")).first()[0] or 0.0
    out = streams.decayed(streams.folded(state, keys, WEEK, at - 4 * WEEK, marks), keys, WEEK, at, marks)
    rounded = out.select("user_id", "key", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"))
    return rounded.withColumn("preferred", streams.preference(F.col("lower"), F.col("upper"), F.lit("default")))


def stream_word_counts(spark, d):
    """Documents as a stream into a store with compaction, and its current counts."""
    docs = _t(spark, d, "documents")
    target = _scratch(spark, "word-store")
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 4).parquet(f"{d}/documents.parquet*")
    streams.incremental_word_counts(stream, target, _scratch(spark, "word-stream"), compact_every=2).awaitTermination()
    return streams.current_counts(spark, target)


def counter_maps(spark, d):
    """A3: where each word is used and how it is spelled, as maps of two batches added up."""
    maps = []
    for table, by in (("documents", "lang"), ("conversations", "role")):
        words = _t(spark, d, table).select(F.col(by).alias("by"), F.explode(F.regexp_extract_all("text", F.lit(r"(\p{L}+)"), 1)).alias("form"))
        pairs = F.array(F.struct(F.lit("forms").alias("dim"), F.col("form").alias("value")), F.struct(F.lit("where").alias("dim"), F.col("by").alias("value")))
        long = words.groupBy("by", "form").agg(F.count("*").alias("n")).select(F.lower("form").alias("key"), "n", F.explode(pairs).alias("x")).select("key", "n", "x.dim", "x.value")
        maps.append(counters.counter_maps(long, ["key", "dim"]))
    out = counters.merged_maps(["key", "dim"], *maps)
    return out.select("key", "dim", "part", F.array_join(F.transform(F.sort_array(F.map_entries("counts")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), " ").alias("counts"))


def _written(spark, path):
    """value and whether the line opens the first part file, read back."""
    lines = spark.read.text(path).select("value", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int").alias("part"))
    return lines.select("value", (F.col("value").startswith("# ") | F.col("value").startswith("lang\t")).alias("head"), "part")


def ordered_words(spark, d):
    """K1, written and read back: the words in order under their counts."""
    words = _t(spark, d, "documents").select(F.explode(X.components(F.col("text"))).alias("surface")).distinct()
    path = _scratch(spark, "ordered-words")
    writers.write_wordlist(words, path, counts={"surfaces": F.count("*"), "keys": F.count_distinct(F.lower("surface")), "upper": F.count_if(X.starts_upper(F.col("surface")))})
    lines = _written(spark, path)
    first = lines.agg(F.min("part").alias("first"))
    return lines.join(F.broadcast(first)).select("value", "head", (F.col("head") & (F.col("part") != F.col("first"))).alias("misplaced"))


def ordered_rows(spark, d):
    """K2, written and read back."""
    rows = _t(spark, d, "documents").groupBy("lang", "source").agg(F.count("*").alias("docs"), F.sort_array(F.collect_set(F.col("doc_id") % 7)).cast("array<string>").alias("rests"), F.min("doc_id").alias("first"))
    path = _scratch(spark, "ordered-rows")
    writers.write_tsv(rows, path, ["lang", "source", "docs", "rests", "first"], ["lang", "docs"])
    return _written(spark, path).select("value", "head")


QUERIES = {f.__name__: f for f in (profile_chain, decayed_uses, stream_word_counts, counter_maps, ordered_words, ordered_rows)}

ORACLE_SQL: dict[str, str] = {
    "profile_chain": r"""WITH p AS (SELECT conv_id, turn, list_filter(string_split_regex(lower(text), '[^\p{L}]+'), lambda x: x <> '')[1:3] AS w, (turn * 10 + length(text) % 10) AS v FROM conversations),
top AS (SELECT a.conv_id, a.turn, max(b.turn) AS root FROM p a JOIN (SELECT p.conv_id, p.turn FROM p LEFT JOIN p q ON q.conv_id = p.conv_id AND q.turn = p.turn - 1 WHERE q.turn IS NULL) b ON b.conv_id = a.conv_id AND b.turn <= a.turn GROUP BY ALL),
an AS (SELECT a.conv_id, a.turn, b.turn AS up, b.w, b.v FROM top a JOIN p b ON b.conv_id = a.conv_id AND b.turn BETWEEN a.root AND a.turn),
m0 AS (SELECT conv_id, turn, up, unnest(w) AS module, generate_subscripts(w, 1) AS i FROM an),
m1 AS (SELECT conv_id, turn, module, min(up * 100 + i) AS o FROM m0 GROUP BY ALL),
m2 AS (SELECT conv_id, turn, string_agg(module, ' ' ORDER BY o) AS modules FROM m1 GROUP BY ALL),
k0 AS (SELECT DISTINCT conv_id, turn, up, v, substr(module, 1, 1) AS k FROM (SELECT conv_id, turn, up, v, unnest(w) AS module FROM an)),
k1 AS (SELECT conv_id, turn, k, arg_max(v, up) AS v FROM k0 GROUP BY ALL),
k2 AS (SELECT conv_id, turn, string_agg(k || '=' || v::varchar, ' ' ORDER BY k) AS priority FROM k1 GROUP BY ALL)
SELECT conv_id::varchar || ':' || turn::varchar AS name, turn - root AS depth, coalesce(modules, '') AS modules, coalesce(priority, '') AS priority FROM top LEFT JOIN m2 USING (conv_id, turn) LEFT JOIN k2 USING (conv_id, turn)""",
    "decayed_uses": f"""WITH {_USES}, e AS (SELECT user_id, key, up, epoch_us(ts::timestamp) / 1e6 AS t FROM u), m AS (SELECT max(t) AS latest FROM e),
x AS (SELECT user_id, key, round(coalesce(sum(pow(2, (t - latest) / {WEEK})) FILTER (NOT up), 0), 6) AS lower, round(coalesce(sum(pow(2, (t - latest) / {WEEK})) FILTER (up), 0), 6) AS upper FROM e, m GROUP BY ALL)
SELECT *, CASE WHEN lower >= 5 AND lower - upper >= 2 THEN 'lowercase' WHEN upper >= 5 AND upper - lower >= 2 THEN 'capitalized' ELSE 'default' END AS preferred FROM x""",
    "stream_word_counts": r"SELECT lang, word, count(*) AS cnt FROM (SELECT lang, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM documents) GROUP BY ALL",
    "counter_maps": r"""WITH f AS (SELECT lang AS src, unnest(regexp_extract_all(text, '\p{L}+')) AS form FROM documents UNION ALL SELECT role, unnest(regexp_extract_all(text, '\p{L}+')) FROM conversations),
l AS (SELECT lower(form) AS key, 'forms' AS dim, form AS value, count(*) AS n FROM f GROUP BY ALL UNION ALL SELECT lower(form), 'where', src, count(*) FROM f GROUP BY ALL)
SELECT key, dim, 0 AS part, string_agg(value || '=' || n::varchar, ' ' ORDER BY value) AS counts FROM l GROUP BY ALL""",
    "ordered_words": r"""WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(regexp_replace(text, '(?i)[''’＇]s\b', '', 'g'), '\p{L}+')) AS s FROM documents)
SELECT s AS value, false AS head, false AS misplaced FROM w UNION ALL SELECT unnest(['# surfaces: ' || count(*)::varchar, '# keys: ' || count(DISTINCT lower(s))::varchar, '# upper: ' || count(*) FILTER (regexp_matches(s, '^\p{Lu}'))::varchar]), true, false FROM w""",
    "ordered_rows": r"""SELECT 'lang' || chr(9) || 'source' || chr(9) || 'docs' || chr(9) || 'rests' || chr(9) || 'first' AS value, true AS head
UNION ALL SELECT concat_ws(chr(9), coalesce(lang, ''), coalesce(source, ''), count(*)::varchar, array_to_string(list_sort(list_distinct(list(doc_id % 7))), ';'), min(doc_id)::varchar), false FROM documents GROUP BY lang, source""",
}
