"""Registered queries over the given tables, with the SQL that must give the same rows.

Thresholds are scaled to the small synthetic corpora, so that each rule meets some word.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.config import WESTERN
from wordloom.functions import text as X
from wordloom.operators import casing, counts, coverage, gates, history, modules, registry, selecting
from wordloom.sources.writers import settled
from wordloom.streaming import streams

CFG = replace(WESTERN, own_cap=5.0, rival_floor=4.5, rival_lead=0.2, known_zipf=5.0, typo_gaps=((3, 0.6), (5, 0.5), (10_000, 0.4)), guards=("de", "la", "le"))
LIMIT, ADDED_LIMIT = 3_000, 2_000
YEARS = range(1995, 2002)
CORRECTIONS = [("teh", "the"), ("thb", "the best"), ("ot", "to"), ("erst", "first"), ("ndou", "and you")]
_CAP, _FLOOR, _LEAD = CFG.own_cap, CFG.rival_floor, CFG.rival_lead
_LETTERS = f"^[{CFG.alphabet}]+$"


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- corpus counts -------------------------------------------------------------------------------------------------

_TOKENS = r"t AS (SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM documents), c AS (SELECT lang, word, count(*) AS cnt FROM t GROUP BY ALL), z AS (SELECT lang, word, cnt, round(log10(cnt * 1e9 / sum(cnt) OVER (PARTITION BY lang)), 6) AS zipf FROM c)"


def word_counts(spark, d):
    return counts.word_counts(_t(spark, d, "documents"))


def _zipfs(spark, d):
    return counts.with_zipf(counts.word_counts(_t(spark, d, "documents")))


def _vocabulary(spark, d):
    """lang, word, cnt, spread, zipf: the corpus is read once, every evidence set comes from this table."""
    return counts.with_zipf(settled(counts.vocabulary(_t(spark, d, "documents")), "vocabulary"))


def _own(zipfs, lang: str = CFG.language):
    return zipfs.where(F.col("lang") == lang)


def _ranked(spark, d, zipfs=None, lang: str = CFG.language):
    from wordloom.sources.readers import ranked_vocabulary

    return ranked_vocabulary(_zipfs(spark, d) if zipfs is None else zipfs, lang, cfg=CFG, keep=("zipf",))


_RANKED = f"r AS (SELECT row_number() OVER (ORDER BY cnt DESC, word) - 1 AS rank, word, cnt, zipf FROM z WHERE lang = 'fr' AND length(word) BETWEEN 1 AND 25 AND regexp_full_match(word, '{_LETTERS[1:-1]}'))"


def word_zipf_rank(spark, d):
    return _ranked(spark, d).select("rank", "word", "cnt", "zipf")


def foreign_dominant(spark, d):
    return selecting.foreign_dominant(_zipfs(spark, d), CFG)


_FOREIGN = f"""w AS (SELECT word, coalesce(max(zipf) FILTER (lang = 'fr'), 0) AS zipf_own FROM z GROUP BY word),
v AS (SELECT word, lang, zipf, row_number() OVER (PARTITION BY word ORDER BY zipf DESC, list_position(['en', 'de', 'es'], lang)) AS k FROM z WHERE lang IN ('en', 'de', 'es')),
f AS (SELECT word, zipf_own, v.lang AS rival, v.zipf AS zipf_rival FROM w JOIN v USING (word) WHERE k = 1 AND zipf >= {_FLOOR} AND zipf > round(zipf_own + {_LEAD}, 6) AND zipf_own < {_CAP})"""


def _spelled(vocabulary, lang: str = CFG.language):
    """Spelling evidence: words of two documents or more."""
    return _own(vocabulary, lang).where("spread").select("word")


_SPELL = "s AS (SELECT word FROM t WHERE lang = 'fr' GROUP BY word HAVING count(DISTINCT doc_id) >= 2)"


def typo_targets(spark, d):
    vocabulary = _vocabulary(spark, d)
    return selecting.typo_targets(_own(vocabulary).select("word", "zipf"), _spelled(vocabulary), CFG)


_DELETES = "unnest(list_distinct(list_transform(range(1, length(word) + 1), lambda i: substring(word, 1, (i - 1)::bigint) || substring(word, (i + 1)::bigint)))) AS k"
_TYPO = f"""o AS (SELECT word, zipf FROM z WHERE lang = 'fr'),
ka AS (SELECT word, {_DELETES} FROM o WHERE word NOT IN (SELECT word FROM s) AND length(word) >= 3 AND zipf < {_CAP}),
kb AS (SELECT word, {_DELETES} FROM o WHERE word IN (SELECT word FROM s) AND length(word) >= 2),
p AS (SELECT DISTINCT ka.word, kb.word AS target FROM ka JOIN kb USING (k) WHERE length(ka.word) = length(kb.word) AND ka.word <> kb.word),
m AS (SELECT word, target, list_filter(range(1, length(word) + 1), lambda i: substring(word, i, 1) <> substring(target, i, 1)) AS m FROM p),
e AS (SELECT word, target, CASE WHEN len(m) = 1 THEN 'substitution' WHEN len(m) = 2 AND m[2] = m[1] + 1 AND substring(word, m[1], 1) = substring(target, m[2], 1) AND substring(word, m[2], 1) = substring(target, m[1], 1) THEN 'transposition' END AS kind FROM m),
g AS (SELECT e.word, target, kind, round(b.zipf - a.zipf, 6) AS gap FROM e JOIN o a ON a.word = e.word JOIN o b ON b.word = e.target WHERE kind IS NOT NULL),
y AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY gap DESC, target) AS k FROM g WHERE gap > 0 AND gap >= CASE WHEN length(word) <= 3 THEN 0.6 WHEN length(word) <= 5 THEN 0.5 ELSE 0.4 END),
typo AS (SELECT word, target, kind, gap FROM y WHERE k = 1)"""


def _cascaded(spark, d, guards: tuple[str, ...] = CFG.guards):
    zipfs = _vocabulary(spark, d)
    ranked = _ranked(spark, d, zipfs)
    spell = _spelled(zipfs)
    sets = {
        "spell": spell,
        "keyboard": _t(spark, d, "conversations").select(F.explode(X.words(F.col("text"))).alias("word")).distinct(),
        "blocked": _t(spark, d, "benchmark").select(F.explode(X.words(F.col("text"))).alias("word")).distinct().join(_own(zipfs).where("cnt < 3").select("word"), "word", "left_semi"),
        "guard": spark.createDataFrame([(g,) for g in guards], "word string"),
    }
    foreign = selecting.foreign_dominant(zipfs, CFG).select("word", "rival")
    typo = selecting.typo_targets(_own(zipfs).select("word", "zipf"), spell, CFG).select("word", F.col("target").alias("typo_target"))
    rows = selecting.attach_evidence(ranked, sets, {"rival": foreign, "typo_target": typo})
    return settled(selecting.suppress_aliases(selecting.cascade(rows), CFG), "cascade")


_CASCADE = rf"""kbd AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS word FROM conversations),
blk AS (SELECT DISTINCT word FROM (SELECT unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS word FROM benchmark) WHERE word IN (SELECT word FROM z WHERE lang = 'fr' AND cnt < 3)),
ev AS (SELECT r.*, r.word IN (SELECT word FROM s) AS sp, r.word IN (SELECT word FROM kbd) AS kb, r.word IN (SELECT word FROM blk) AS bl, r.word IN ('de', 'la', 'le') AS gd, f.rival, typo.target AS tt
  FROM r LEFT JOIN f ON f.word = r.word LEFT JOIN typo ON typo.word = r.word),
c1 AS (SELECT *, CASE WHEN bl THEN 'reviewed-typo-blocklist' WHEN gd THEN 'guard' WHEN rival IS NOT NULL THEN 'foreign:' || rival WHEN regexp_full_match(word, '[\x00-\x7F]*') AND NOT (sp AND kb) THEN 'ascii-without-dual-evidence'
  WHEN NOT (sp OR kb) AND tt IS NOT NULL THEN 'typo->' || tt WHEN NOT (sp OR kb) THEN 'no-positive-evidence' ELSE 'spell-evidence' END AS why FROM ev),
c2 AS (SELECT *, why IN ('guard', 'spell-evidence') AS kept, translate(word, '{CFG.marked}', '{CFG.unmarked}') AS fold, regexp_matches(word, '[{CFG.marked}]') AS marked FROM c1),
acc AS (SELECT fold, word AS accented, sp OR kb AS pos, row_number() OVER (PARTITION BY fold ORDER BY zipf DESC, word) AS k FROM c2 WHERE kept AND marked),
c3 AS (SELECT c2.*, kept AND NOT marked AND NOT (sp OR kb OR gd) AND coalesce(acc.pos, false) AS alias, acc.accented FROM c2 LEFT JOIN acc ON acc.fold = c2.fold AND acc.k = 1),
c4 AS (SELECT * EXCLUDE (kept, why), kept AND NOT alias AS kept, CASE WHEN alias THEN 'diacritic-alias->' || accented ELSE why END AS why FROM c3)"""


def _cut_sql(name: str, source: str, limit: int, shield: str) -> str:
    return f"""{name} AS (SELECT *, kept AND ((SELECT count(*) FROM {source} WHERE kept) <= {limit} OR {shield} OR row_number() OVER (PARTITION BY kept AND NOT {shield} ORDER BY rank, zipf DESC, word) <= {limit} - (SELECT count(*) FROM {source} WHERE kept AND {shield})) AS stays FROM {source})"""


def select_words(spark, d):
    """Flagship: C1-C3 with a reason for each word (K5)."""
    rows = selecting.capacity_cut(_cascaded(spark, d), LIMIT, F.col("guard"))
    return rows.select("rank", "word", "zipf", "decision", "reason")


def select_reasons(spark, d):
    return selecting.reason_counts(select_words(spark, d))


def capacity_displaced(spark, d):
    """Words that the cut loses to accented words without spelling evidence, taken as the added layer."""
    rows = _cascaded(spark, d)
    added = X.has_mark(F.col("word"), CFG) & F.col("keyboard")
    return selecting.displaced(rows, ADDED_LIMIT, added, F.col("guard") | added & (F.col("rank") % 7 == 0), F.col("guard")).select("word")


def alias_suppressed(spark, d):
    rows = _own(counts.with_zipf(counts.vocabulary(_t(spark, d, "documents")))).select("word", "zipf", F.col("spread").alias("spell"))
    known = rows.where(X.has_mark(F.col("word"), CFG) | ~F.col("spell"))
    kept = known.withColumn("decision", F.lit("keep")).withColumn("reason", F.lit("candidate"))
    return selecting.suppress_aliases(kept, CFG).where("decision = 'drop'").select("word", "reason")


def evidence_coverage(spark, d):
    vocabulary = _vocabulary(spark, d)
    rows = selecting.with_evidence(_ranked(spark, d, vocabulary), {"spell": _spelled(vocabulary), "keyboard": _t(spark, d, "conversations").select(F.explode(X.words(F.col("text"))).alias("word"))})
    return coverage.evidence_coverage(rows.withColumn("marked", X.has_mark(F.col("word"), CFG)), ["spell", "keyboard", "marked"])


def accent_index(spark, d):
    rows = coverage.accent_index(_ranked(spark, d), CFG)
    return rows.select("fold", F.size("candidates").alias("n"), F.array_join("candidates", " ").alias("candidates"))


def accent_probe(spark, d):
    ranked = _ranked(spark, d)
    probes = _t(spark, d, "benchmark").select(F.explode(X.words(F.col("text"))).alias("word")).distinct()
    out = coverage.probe_index(probes, ranked, coverage.accent_index(ranked, CFG), counts.unigrams(ranked, 500), CFG)
    return out.select("word", "fold", "rank", "listed", "unigram", F.size(F.coalesce("candidates", F.array().cast("array<string>"))).alias("n_candidates"))


def _named(spark, d):
    """(kind, canonical) of the name tables' words."""
    sources = (("part", "part", "p_name"), ("supplier", "supplier", "s_name"), ("customer", "customer", "c_name"), ("nation", "nation", "n_name"))
    out = None
    for kind, table, column in sources:
        part = _t(spark, d, table).select(F.lit(kind).alias("kind"), F.explode(X.components(F.col(column))).alias("canonical"))
        out = part if out is None else out.unionByName(part)
    return out.distinct()


_NAMES = r"n AS (SELECT DISTINCT * FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS kind, unnest(regexp_extract_all({c}, '\\p{{L}}+')) AS canonical FROM {k}" for k, c in (("part", "p_name"), ("supplier", "s_name"), ("customer", "c_name"), ("nation", "n_name"))) + "))"


def coverage_status(spark, d):
    pack = _t(spark, d, "documents").select(F.explode(X.components(F.col("text"))).alias("surface")).distinct()
    names = _t(spark, d, "conversations").select("role", F.explode(X.components(F.col("text"))).alias("canonical")).distinct().withColumnRenamed("role", "kind")
    return coverage.status_counts(coverage.coverage_status(names, pack))


def kind_collision(spark, d):
    return coverage.kind_collisions(_named(spark, d)).select("key", F.array_join("kinds", " ").alias("kinds"))


def case_evidence(spark, d):
    return casing.observed_casing(_t(spark, d, "documents"))


_OBSERVED = r"""raw AS (SELECT lang, unnest(regexp_extract_all(text, '((?:^|[.!?:]\s+|\n\s*)?\p{L}+)', 1)) AS raw FROM documents),
rw AS (SELECT lang, raw, regexp_extract(raw, '(\p{L}+)$', 1) AS w FROM raw),
ob AS (SELECT lang, lower(w) AS key, count(*) FILTER (regexp_matches(w, '^\p{Lu}')) AS upper, count(*) FILTER (regexp_matches(w, '^\p{Ll}')) AS lower, count(*) FILTER (regexp_matches(w, '^\p{Lu}') AND raw <> w) AS upper_at_start FROM rw GROUP BY ALL)"""


def case_verdict(spark, d):
    return casing.observed_verdict(casing.observed_casing(_t(spark, d, "documents"))).groupBy("lang", "policy").agg(F.count("*").alias("n"), F.sum("lower").alias("lower_uses"), F.sum("upper").alias("upper_uses"))


def module_cost(spark, d):
    core = _t(spark, d, "documents").select(F.explode(X.words(F.col("text"))).alias("surface")).distinct()
    spoken = _t(spark, d, "conversations").select(F.explode(X.components(F.col("text"))).alias("surface"))
    asked = _t(spark, d, "benchmark").select(F.explode(X.components(F.col("text"))).alias("surface"))
    paged = _t(spark, d, "pages").select(F.explode(X.components(F.col("url"))).alias("surface"))
    mods = None
    for i, (name, df) in enumerate((("benchmark", asked), ("conversations", spoken), ("pages", paged)), 1):
        part = df.distinct().select(F.lit(i).alias("ord"), F.lit(name).alias("module"), "surface")
        mods = part if mods is None else mods.unionByName(part)
    return modules.module_costs(core, mods)


def freq_percentiles(spark, d):
    return counts.percentiles(_zipfs(spark, d), "zipf", by=["lang"])


def _sales(spark, d):
    o, c = _t(spark, d, "orders"), _t(spark, d, "customer")
    rows = o.join(c, o.o_custkey == c.c_custkey).select(F.col("c_mktsegment").alias("grp"), F.col("c_nationkey").cast("string").alias("name"), F.year("o_orderdate").alias("year"), F.lit(1).cast("long").alias("cnt"))
    return history.yearly_rank(history.yearly_sums(rows))


_SALES = """h AS (SELECT c_mktsegment AS grp, c_nationkey::varchar AS name, year(o_orderdate)::int AS year, count(*) AS cnt FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
yr AS (SELECT *, row_number() OVER (PARTITION BY grp, year ORDER BY cnt DESC, name) AS year_rank FROM h),
hf AS (SELECT grp, name, sum(cnt)::bigint AS cumulative_count, count(*) AS years_present, count(*) FILTER (year_rank <= 5) AS years_top5, count(*) FILTER (year_rank <= 10) AS years_top10, coalesce(sum(cnt) FILTER (year > @LAST - 5), 0)::bigint AS recent_count FROM yr GROUP BY ALL),
hr AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY cumulative_count DESC, years_top10 DESC, recent_count DESC, name) AS cumulative_rank FROM hf)""".replace("@LAST", str(YEARS[-1]))


def yearly_rank(spark, d):
    return _sales(spark, d)


def _history(spark, d):
    return history.cumulative_rank(history.features(_sales(spark, d), YEARS[-1], top=(5, 10)), "years_top10")


def history_features(spark, d):
    return _history(spark, d).drop("year_counts", "year_ranks")


def history_core(spark, d):
    return history.core_and_buffer(_history(spark, d), 5, 8).select("grp", "name", "cumulative_rank", "band")


def history_thresholds(spark, d):
    return history.thresholds(_history(spark, d), (3, 10, 100))


def unpivot_roundtrip(spark, d):
    o = _t(spark, d, "orders")
    wide = o.select(F.col("o_orderpriority").alias("name"), F.year("o_orderdate").alias("y")).groupBy("name").pivot("y", list(YEARS)).count()
    long = wide.unpivot("name", [str(y) for y in YEARS], "year", "cnt").where("cnt is not null")
    return long.withColumn("year", F.col("year").cast("int"))


def retention_by_level(spark, d):
    """Orders as forms of their customers: the priority stands for the level; forms of finished orders are those the corpus has."""
    o = _t(spark, d, "orders")
    level = F.when(F.col("o_orderpriority") < "2", "voivodeship").when(F.col("o_orderpriority") < "4", "powiat").otherwise("gmina")
    case = F.element_at(F.array(*map(F.lit, ("nom", "gen", "loc"))), (F.pmod("o_orderkey", F.lit(3)) + 1).cast("int"))
    form = F.concat(F.lit("f"), F.pmod("o_orderkey", F.lit(9973)).cast("string"))
    forms = o.select(level.alias("level"), F.col("o_custkey").cast("string").alias("code"), F.lit("unit").alias("name"), case.alias("case"), form.alias("form")).distinct()
    seen = o.where("o_orderstatus = 'F'").groupBy(F.lower(form).alias("word")).agg(F.count("*").alias("cnt"))
    zipfs = forms.select(F.lower("form").alias("word")).distinct().withColumn("zipf", F.length("word").cast("double"))
    return selecting.retain_by_level(forms, seen, zipfs)


def snapshot_diff(spark, d):
    docs = _t(spark, d, "documents")
    def ranks(half: int) -> DataFrame:
        c = docs.where(F.pmod("doc_id", F.lit(2)) == half).select(F.explode(X.words(F.col("text"))).alias("key")).groupBy("key").agg(F.count("*").alias("cnt"))
        return selecting.number_rows(c, [F.desc("cnt"), F.col("key")], "rank").select("key", "rank")

    return coverage.snapshot_diff(ranks(0), ranks(1)).select("key", "change", "old_rank", "new_rank")


def registry_resolve(spark, d):
    """Sources: nation names, part names and the observed casing of the English documents."""
    seen = casing.observed_verdict(casing.observed_casing(_t(spark, d, "documents").where("lang = 'en'")))
    seen = seen.select("key", X.apply_policy(F.col("key"), F.col("policy")).alias("surface"), "policy")
    named, _ = registry.canonicalize(_named(spark, d).where("kind in ('nation', 'part')").select(F.col("canonical").alias("surface")), conflict_mode="prefer_capitalized")
    kept = seen.select(F.col("key").alias("word")).union(named.select("key")).distinct()
    built = registry.build_registry({"observed": seen, "names": named}, kept)
    return registry.resolve_registry(built).select("key", "surface", "policy", "basis", "several_surfaces", "conflict")


def list_quality(spark, d):
    rows = _t(spark, d, "documents").select("lang", F.explode(X.components(F.col("text"))).alias("surface"))
    return counts.list_quality(rows, by=["lang"])


def source_profile(spark, d):
    lines = _t(spark, d, "documents").select(F.explode(F.split("text", "\n", -1)).alias("value"))
    return counts.source_profile(lines, 3, 1, sep=" ")


def bigram_topk(spark, d):
    """Ranked by count; the weight of those kept needs each language's largest count, which one of them has."""
    best = counts.top_next(counts.pair_counts(counts.spread(_t(spark, d, "documents"))), 3)
    most = best.groupBy("lang").agg(F.max("cnt").alias("most"))
    return best.join(F.broadcast(most), "lang").withColumn("weight", F.floor(F.lit(1000) * F.col("cnt") / F.col("most")).cast("int")).drop("most")


def bigram_weights(spark, d):
    return counts.bigrams(counts.spread(_t(spark, d, "documents")))


def _words(spark, d, table: str):
    return _t(spark, d, table).select(F.explode(X.words(F.col("text"))).alias("word"))


def candidate_ranks(spark, d):
    base = counts.word_counts(_t(spark, d, "documents")).groupBy("word").agg(F.sum("cnt").alias("cnt"))
    return selecting.candidate_ranks(base, [_words(spark, d, "conversations"), _words(spark, d, "benchmark")]).select("rank", "word", "layer")


def candidate_gate(spark, d):
    return selecting.gate_candidates(counts.word_counts(_t(spark, d, "documents")).select("word").distinct(), CFG)[1]


def vocabulary(spark, d):
    return counts.vocabulary(_t(spark, d, "documents"))


def top_zipf(spark, d):
    return selecting.top_sample(_own(_zipfs(spark, d)).select("word", "zipf"), "zipf")


def audit_status(spark, d):
    """C5 over all French words: benchmark words are the regression list, spoken ones the preview."""
    zipf = lambda *langs: F.coalesce(F.max(F.when(F.col("lang").isin(*langs), F.col("zipf"))), F.lit(0.0))
    rows = _zipfs(spark, d).groupBy("word").agg(zipf(CFG.language).alias("zipf_own"), zipf(*CFG.rivals).alias("zipf_rival")).where("zipf_own > 0")
    rows = selecting.with_evidence(rows, {"regression": _words(spark, d, "benchmark"), "in_preview": _words(spark, d, "conversations")})
    return selecting.audit_status(rows.withColumn("excluded", F.col("word").isin(*CFG.guards)), CFG).select("word", "audit_status")


def module_seen(spark, d):
    """How many of the spoken and the asked surfaces the documents hold."""
    forms = counts.word_counts(_t(spark, d, "documents")).groupBy(F.col("word").alias("form")).agg(F.sum("cnt").alias("cnt"))
    surfaces = [_t(spark, d, t).select(F.lit(t).alias("module"), F.explode(X.components(F.col("text"))).alias("surface")).distinct() for t in ("conversations", "benchmark")]
    return counts.seen_summary(counts.seen_counts(surfaces[0].unionByName(surfaces[1]), forms))


def form_weights(spark, d):
    """A3, A4 over the documents' surfaces as a tagged table."""
    found = _t(spark, d, "documents").select("lang", "source", F.explode(X.components(F.col("text"))).alias("form"))
    none = F.lit("")
    tagged = found.groupBy("lang", "source", "form").agg(F.count("*").alias("frequency")).select("form", F.lower("form").alias("lemma"), F.col("lang").alias("tag"), F.col("source").alias("classification"), none.alias("sgjp_status"), none.alias("correctness"), none.alias("morphology"), "frequency")
    return casing.case_weights(casing.evidence_long(tagged))


def prefix_top3(spark, d):
    entries = _t(spark, d, "documents").select(F.explode(X.words(F.col("text"))).alias("word")).distinct()
    prefixes = _t(spark, d, "benchmark").select(F.explode(X.words(F.col("text"))).alias("w")).select(F.substring("w", 1, 4).alias("prefix")).distinct()
    return counts.prefix_completion(entries, prefixes)


def apply_corrections(spark, d):
    return counts.apply_corrections(_t(spark, d, "documents"), spark.createDataFrame(CORRECTIONS, "wrong string, canonical string")).select("doc_id", F.md5(F.col("corrected").cast("binary")).alias("corrected_md5"), "n_changed")


def correction_gate(spark, d):
    words = _t(spark, d, "documents").select(F.explode(X.words(F.col("text"))).alias("word"))
    return counts.correction_gate(spark.createDataFrame(CORRECTIONS, "wrong string, canonical string"), words)


def _uses(spark, d):
    upper = F.pmod(F.length("event_type"), F.lit(2)) == 1
    return _t(spark, d, "events").select("ts", "user_id", F.lower("event_type").alias("key"), F.when(upper, X.upper_first(F.lower("event_type"))).otherwise(F.when(F.col("value") > 20, X.upper_first(F.lower("event_type"))).otherwise(F.lower("event_type"))).alias("surface"))


def case_preference(spark, d):
    return streams.case_preferences(_uses(spark, d))


def windowed_uses(spark, d):
    out = streams.windowed_uses(_uses(spark, d), ["key"])
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


def component_surfaces(spark, d):
    names = _t(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    line = F.col("line")
    return names.select("doc_id", F.size(X.components(line)).alias("n"), X.is_multi_component(line).alias("multi"), F.array_join(X.components(line), "|").alias("parts"), X.fold(line, CFG).alias("folded"))


def related_forms(spark, d):
    words = _t(spark, d, "documents").select(F.explode(X.words(F.col("text"))).alias("word")).distinct()
    return casing.related_forms(words, CFG).select(F.col("group"), F.array_join("forms", " ").alias("forms"))


def gate_report(spark, d):
    """G1-G5 over the star schema: each violation counts once."""
    o, c, n = _t(spark, d, "orders"), _t(spark, d, "customer"), _t(spark, d, "nation")
    checks = {
        "priority-domain": gates.domain(o, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]),
        "unknown-customer": gates.missing(o.withColumnRenamed("o_custkey", "c_custkey"), c, "c_custkey"),
        "segment-conflict": gates.conflicts(c, "c_nationkey", "c_mktsegment"),
        "duplicate-date": gates.duplicates(o, ["o_custkey", "o_orderdate"]),
        "nation-count": gates.cardinality(n, {"nation": 25}).where("not ok"),
    }
    out = None
    for name, rows in checks.items():
        part = rows.agg(F.count("*").alias("violations")).withColumn("gate", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out.select("gate", "violations")


QUERIES = {
    f.__name__: f
    for f in (
        word_counts, word_zipf_rank, foreign_dominant, typo_targets, select_words, select_reasons, capacity_displaced, alias_suppressed, evidence_coverage, accent_index, accent_probe, coverage_status, kind_collision,
        case_evidence, case_verdict, module_cost, freq_percentiles, yearly_rank, history_features, history_core, history_thresholds, unpivot_roundtrip, retention_by_level, snapshot_diff, registry_resolve, list_quality,
        bigram_weights, candidate_ranks, candidate_gate, vocabulary, top_zipf, audit_status, module_seen, form_weights,
        source_profile, bigram_topk, prefix_top3, apply_corrections, correction_gate, case_preference, windowed_uses, component_surfaces, related_forms, gate_report,
    )
}

_SELECT = f"WITH {_TOKENS}, {_RANKED}, {_FOREIGN}, {_SPELL}, {_TYPO}, {_CASCADE}"
_CHOSEN = f"{_SELECT}, {_cut_sql('cut', 'c4', LIMIT, 'gd')}, chosen AS (SELECT rank, word, zipf, CASE WHEN stays THEN 'keep' ELSE 'drop' END AS decision, CASE WHEN kept AND NOT stays THEN 'limit-cut' ELSE why END AS reason FROM cut)"
_EN = r"en AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM documents)"
_FIX = "fix(wrong, canonical) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in CORRECTIONS) + ")"
_USES = "u AS (SELECT ts, user_id, lower(event_type) AS key, length(event_type) % 2 = 1 OR value > 20 AS up FROM events)"

def _spoken(table: str) -> str:
    return rf"SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS word FROM {table}"


def _surfaces(table: str) -> str:
    return rf"unnest(regexp_extract_all(regexp_replace(text, '(?i)[''’＇]s\b', '', 'g'), '\p{{L}}+')) AS surface FROM {table}"


ORACLE_SQL: dict[str, str] = {
    "bigram_weights": r"WITH w AS (SELECT lang, regexp_extract_all(lower(text), '\p{L}+') AS w FROM documents), p AS (SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: {'previous': w[i], 'current': w[i + 1]}), recursive := true) FROM w), c AS (SELECT lang, previous, current, count(*) AS cnt FROM p GROUP BY ALL) SELECT *, floor(1000 * cnt / max(cnt) OVER (PARTITION BY lang))::int AS weight FROM c",
    "candidate_ranks": f"WITH {_TOKENS}, u AS (SELECT word, 0 AS layer, sum(cnt)::bigint AS cnt FROM c GROUP BY word UNION ALL SELECT word, 1, 0 FROM ({_spoken('conversations')}) UNION ALL SELECT word, 2, 0 FROM ({_spoken('benchmark')})), m AS (SELECT word, min(layer)::int AS layer, max(cnt) AS cnt FROM u GROUP BY word) SELECT row_number() OVER (ORDER BY layer, cnt DESC, word) - 1 AS rank, word, layer FROM m",
    "candidate_gate": f"WITH {_TOKENS}, w AS (SELECT DISTINCT word FROM c), g AS (SELECT length(word) BETWEEN 1 AND 25 AND regexp_full_match(word, '{_LETTERS[1:-1]}') AS ok FROM w) SELECT count(*) FILTER (ok) AS accepted, count(*) FILTER (NOT ok) AS rejected FROM g",
    "vocabulary": f"WITH {_TOKENS} SELECT lang, word, count(*) AS cnt, count(DISTINCT doc_id) >= 2 AS spread FROM t GROUP BY ALL",
    "top_zipf": f"WITH {_TOKENS} SELECT word, zipf FROM z WHERE lang = '{CFG.language}' ORDER BY zipf DESC, word LIMIT 100",
    "audit_status": f"""WITH {_TOKENS}, b AS ({_spoken('benchmark')}), k AS ({_spoken('conversations')}),
w AS (SELECT word, max(zipf) FILTER (lang = 'fr') AS own, coalesce(max(zipf) FILTER (lang IN ('en', 'de', 'es')), 0) AS rival FROM z GROUP BY word)
SELECT word, CASE WHEN word IN (SELECT word FROM b) THEN 'BLOCKED_REGRESSION' WHEN word IN ('de', 'la', 'le') THEN 'SOURCE_EXCLUDED' WHEN word NOT IN (SELECT word FROM k) THEN 'NOT_IN_PREVIEW'
  WHEN rival >= {_FLOOR} AND rival > own + {_LEAD}::double THEN 'IN_PREVIEW_FOREIGN_SIGNAL' WHEN own >= {CFG.common_zipf} THEN 'IN_PREVIEW_COMMON_WORD_SIGNAL' ELSE 'IN_PREVIEW_CLEAN_SIGNAL' END AS audit_status FROM w WHERE own > 0""",
    "module_seen": f"WITH {_TOKENS}, e AS (SELECT DISTINCT word FROM c), m AS (SELECT DISTINCT 'conversations' AS module, {_surfaces('conversations')} UNION ALL SELECT DISTINCT 'benchmark', {_surfaces('benchmark')}) SELECT module, count(*) FILTER (lower(surface) IN (SELECT word FROM e)) AS n_seen, count(*) FILTER (lower(surface) NOT IN (SELECT word FROM e)) AS n_unseen FROM m GROUP BY module",
    "form_weights": rf"WITH f AS (SELECT {_surfaces('documents')}) SELECT lower(surface) AS key, count(*) FILTER (regexp_matches(surface, '^\p{{Lu}}')) AS upper, count(*) FILTER (regexp_matches(surface, '^\p{{Ll}}')) AS lower FROM f GROUP BY 1",
    "word_counts": f"WITH {_TOKENS} SELECT * FROM c",
    "word_zipf_rank": f"WITH {_TOKENS}, {_RANKED} SELECT * FROM r",
    "foreign_dominant": f"WITH {_TOKENS}, {_FOREIGN} SELECT * FROM f",
    "typo_targets": f"WITH {_TOKENS}, {_SPELL}, {_TYPO} SELECT * FROM typo",
    "select_words": f"{_CHOSEN} SELECT * FROM chosen",
    "select_reasons": f"{_CHOSEN} SELECT decision, split_part(split_part(reason, '->', 1), ':', 1) AS reason_class, count(*) AS n FROM chosen GROUP BY ALL",
    "capacity_displaced": f"{_SELECT}, a AS (SELECT *, marked AND kb AS added, gd OR (marked AND kb AND rank % 7 = 0) AS shield FROM c4), {_cut_sql('c5', 'a', ADDED_LIMIT, 'shield')}, b AS (SELECT * FROM a WHERE NOT added), {_cut_sql('c6', 'b', ADDED_LIMIT, 'gd')} SELECT word FROM c6 WHERE stays EXCEPT SELECT word FROM c5 WHERE stays",
    "alias_suppressed": f"WITH {_TOKENS}, {_SPELL}, a AS (SELECT word, zipf, word IN (SELECT word FROM s) AS sp, regexp_matches(word, '[{CFG.marked}]') AS marked, translate(word, '{CFG.marked}', '{CFG.unmarked}') AS fold FROM z WHERE lang = 'fr'), b AS (SELECT * FROM a WHERE marked OR NOT sp), best AS (SELECT fold, word AS accented, sp, row_number() OVER (PARTITION BY fold ORDER BY zipf DESC, word) AS k FROM b WHERE marked) SELECT b.word, 'diacritic-alias->' || accented AS reason FROM b JOIN best ON best.fold = b.fold AND best.k = 1 AND best.sp WHERE NOT b.marked AND NOT b.sp",
    "evidence_coverage": rf"WITH {_TOKENS}, {_RANKED}, {_SPELL}, kbd AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS word FROM conversations), e AS (SELECT word IN (SELECT word FROM s) AS sp, word IN (SELECT word FROM kbd) AS kb, regexp_matches(word, '[{CFG.marked}]') AS mk FROM r) SELECT count(*) AS n, count(*) FILTER (sp) AS n_spell, round(100 * count(*) FILTER (sp) / count(*), 2) AS pct_spell, count(*) FILTER (kb) AS n_keyboard, round(100 * count(*) FILTER (kb) / count(*), 2) AS pct_keyboard, count(*) FILTER (mk) AS n_marked, round(100 * count(*) FILTER (mk) / count(*), 2) AS pct_marked FROM e",
    "accent_index": f"WITH {_TOKENS}, {_RANKED} SELECT translate(word, '{CFG.marked}', '{CFG.unmarked}') AS fold, count(*)::int AS n, string_agg(word, ' ' ORDER BY rank) AS candidates FROM r GROUP BY 1",
    "accent_probe": rf"WITH {_TOKENS}, {_RANKED}, p AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS word FROM benchmark), i AS (SELECT translate(word, '{CFG.marked}', '{CFG.unmarked}') AS fold, count(*)::int AS n FROM r GROUP BY 1), q AS (SELECT word, translate(word, '{CFG.marked}', '{CFG.unmarked}') AS fold FROM p) SELECT q.word, q.fold, r.rank, r.rank IS NOT NULL AS listed, coalesce(r.rank < 500, false) AS unigram, coalesce(i.n, 0) AS n_candidates FROM q LEFT JOIN r ON r.word = q.word LEFT JOIN i ON i.fold = q.fold",
    "coverage_status": r"WITH pack AS (SELECT DISTINCT unnest(regexp_extract_all(regexp_replace(text, '(?i)[''’＇]s\b', '', 'g'), '\p{L}+')) AS s FROM documents), n AS (SELECT DISTINCT role AS kind, unnest(regexp_extract_all(regexp_replace(text, '(?i)[''’＇]s\b', '', 'g'), '\p{L}+')) AS canonical FROM conversations) SELECT kind, CASE WHEN canonical IN (SELECT s FROM pack) THEN 'canonical_present' WHEN lower(canonical) IN (SELECT lower(s) FROM pack) THEN 'lowercase_only' ELSE 'missing_from_pack' END AS status, count(*) AS n FROM n GROUP BY ALL",
    "kind_collision": f"WITH {_NAMES} SELECT lower(canonical) AS key, string_agg(DISTINCT kind, ' ' ORDER BY kind) AS kinds FROM n GROUP BY 1 HAVING count(DISTINCT kind) > 1",
    "case_evidence": f"WITH {_OBSERVED} SELECT * FROM ob",
    "case_verdict": f"WITH {_OBSERVED}, v AS (SELECT *, CASE WHEN upper - upper_at_start > lower THEN 'capitalized' WHEN lower > upper - upper_at_start THEN 'lowercase' END AS policy FROM ob) SELECT lang, policy, count(*) AS n, sum(lower)::bigint AS lower_uses, sum(upper)::bigint AS upper_uses FROM v WHERE policy IS NOT NULL GROUP BY ALL",
    "module_cost": rf"WITH {_EN}, m AS (SELECT DISTINCT * FROM (SELECT 1 AS ord, 'benchmark' AS module, unnest(regexp_extract_all(regexp_replace(text, '(?i)[''’＇]s\b', '', 'g'), '\p{{L}}+')) AS surface FROM benchmark UNION ALL SELECT 2, 'conversations', unnest(regexp_extract_all(regexp_replace(text, '(?i)[''’＇]s\b', '', 'g'), '\p{{L}}+')) FROM conversations UNION ALL SELECT 3, 'pages', unnest(regexp_extract_all(regexp_replace(url, '(?i)[''’＇]s\b', '', 'g'), '\p{{L}}+')) FROM pages)), k AS (SELECT ord, module, lower(surface) AS key, count(*) AS surfaces, bool_or(lower(surface) IN (SELECT word FROM en)) AS in_base, bool_or(surface <> lower(surface)) AS differs FROM m GROUP BY ALL), w AS (SELECT *, min(ord) OVER (PARTITION BY key) AS owner FROM k) SELECT ord, module, sum(surfaces)::bigint AS source_surfaces, count(*) AS unique_keys, (sum(surfaces) - count(*))::bigint AS case_variants_collapsed, count(*) FILTER (in_base) AS already_in_base, count(*) FILTER (in_base AND differs) AS surface_replacements, count(*) FILTER (NOT in_base) AS new_vs_base, count(*) FILTER (NOT in_base AND owner = ord) AS new_after_previous, count(*) FILTER (NOT in_base AND owner <> ord) AS overlap_with_previous FROM w GROUP BY ALL",
    "freq_percentiles": f"WITH {_TOKENS} SELECT lang, count(zipf) AS n, " + ", ".join(f"round(quantile_cont(zipf, {q}), 6) AS p{round(100 * q)}" for q in (0.1, 0.25, 0.5, 0.75, 0.9, 0.95)) + " FROM z GROUP BY lang",
    "yearly_rank": f"WITH {_SALES} SELECT * FROM yr",
    "history_features": f"WITH {_SALES} SELECT * FROM hr",
    "history_core": f"WITH {_SALES} SELECT grp, name, cumulative_rank, CASE WHEN cumulative_rank <= 5 THEN 'core' ELSE 'buffer' END AS band FROM hr WHERE cumulative_rank <= 8",
    "history_thresholds": f"WITH {_SALES}, l AS (SELECT grp, unnest([3, 10, 100]) AS n, max(cumulative_rank) AS size FROM hr GROUP BY grp) SELECT l.grp, n, least(n, size)::bigint AS cumulative_rank, name, cumulative_count FROM l JOIN hr ON hr.grp = l.grp AND hr.cumulative_rank = least(n, size)",
    "unpivot_roundtrip": "SELECT o_orderpriority AS name, year(o_orderdate)::int AS year, count(*) AS cnt FROM orders GROUP BY ALL",
    "retention_by_level": """WITH f AS (SELECT DISTINCT CASE WHEN o_orderpriority < '2' THEN 'voivodeship' WHEN o_orderpriority < '4' THEN 'powiat' ELSE 'gmina' END AS level, o_custkey::varchar AS code, 'unit' AS name, ['nom', 'gen', 'loc'][o_orderkey % 3 + 1] AS "case", 'f' || (o_orderkey % 9973)::varchar AS form FROM orders),
a AS (SELECT *, "case" <> 'nom' AND form IN (SELECT 'f' || (o_orderkey % 9973)::varchar FROM orders WHERE o_orderstatus = 'F') AS seen FROM f),
b AS (SELECT *, bool_or(seen) OVER g AS any_seen, row_number() OVER (PARTITION BY level, code, name, "case" = 'nom' ORDER BY length(form) DESC, CASE "case" WHEN 'gen' THEN 7 WHEN 'loc' THEN 6 ELSE 1 END DESC, form DESC) = 1 AND "case" <> 'nom' AS best, bool_or("case" <> 'nom') OVER g AS other FROM a WINDOW g AS (PARTITION BY level, code, name)),
k AS (SELECT *, "case" = 'nom' OR level = 'voivodeship' OR (level = 'powiat' AND CASE WHEN any_seen THEN seen ELSE best END) AS kept FROM b)
SELECT level, code, name, "case", form, kept, CASE WHEN kept THEN CASE WHEN level = 'voivodeship' THEN 'full' WHEN level = 'gmina' THEN 'nominative-only' WHEN any_seen THEN 'nkjp-observed' WHEN other THEN 'weighted-fallback' ELSE 'nominative-only-no-non-nom' END WHEN level = 'gmina' THEN 'excluded-gmina-nominative-only' ELSE 'excluded-powiat-frequency-not-observed' END AS retention FROM k""",
    "snapshot_diff": r"WITH t AS (SELECT doc_id % 2 AS half, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS key FROM documents), c AS (SELECT half, key, count(*) AS cnt FROM t GROUP BY ALL), r AS (SELECT half, key, row_number() OVER (PARTITION BY half ORDER BY cnt DESC, key) - 1 AS rank FROM c), a AS (SELECT key, rank AS old_rank FROM r WHERE half = 0), b AS (SELECT key, rank AS new_rank FROM r WHERE half = 1), d AS (SELECT key, CASE WHEN old_rank IS NULL THEN 'added' WHEN new_rank IS NULL THEN 'removed' WHEN old_rank <> new_rank THEN 'rank_changed' END AS change, old_rank, new_rank FROM a FULL JOIN b USING (key)) SELECT * FROM d WHERE change IS NOT NULL",
    "registry_resolve": rf"WITH {_OBSERVED}, {_NAMES}, seen AS (SELECT key, CASE WHEN upper - upper_at_start > lower THEN 'capitalized' ELSE 'lowercase' END AS policy FROM ob WHERE lang = 'en' AND upper - upper_at_start <> lower), nm AS (SELECT lower(canonical) AS key, min(CASE WHEN regexp_matches(canonical, '^\p{{Lu}}') THEN 0 ELSE 1 END) AS lowp, min(canonical) FILTER (regexp_matches(canonical, '^\p{{Lu}}')) AS cap FROM n WHERE kind IN ('nation', 'part') GROUP BY 1), reg AS (SELECT key, CASE WHEN policy = 'capitalized' THEN upper(key[1]) || key[2:] ELSE key END AS surface, policy FROM seen UNION SELECT key, CASE WHEN lowp = 0 THEN cap ELSE key END, CASE WHEN lowp = 0 THEN 'capitalized' ELSE 'lowercase' END FROM nm), q AS (SELECT key, count(DISTINCT policy) AS np, count(DISTINCT surface) AS ns, min(surface) AS surface, min(policy) AS policy FROM reg GROUP BY key) SELECT key, CASE WHEN np = 1 THEN surface END AS surface, CASE WHEN np = 1 THEN policy END AS policy, CASE WHEN np = 1 THEN 'source' ELSE 'conflict' END AS basis, ns > 1 AS several_surfaces, np > 1 AS conflict FROM q",
    "list_quality": r"WITH t AS (SELECT lang, unnest(regexp_extract_all(regexp_replace(text, '(?i)[''’＇]s\b', '', 'g'), '\p{L}+')) AS s FROM documents) SELECT lang, count(*) AS entries, count(DISTINCT lower(s)) AS unique_keys, count(*) - count(DISTINCT lower(s)) AS duplicates FROM t GROUP BY lang",
    "source_profile": r"WITH l AS (SELECT unnest(string_split(text, chr(10))) AS v FROM documents), x AS (SELECT v, trim(v, ' ') = '' AS e, starts_with(ltrim(v, ' '), '#') AS h, string_split(v, ' ') AS p FROM l), y AS (SELECT *, NOT e AND NOT h AS d, TRY_CAST(p[2] AS bigint) AS n FROM x), q AS (SELECT *, d AND len(p) = 3 AS f FROM y) SELECT count(*) AS lines, count(*) FILTER (e) AS empty_rows, count(*) FILTER (h) AS comment_rows, count(*) FILTER (d) AS data_rows, count(*) FILTER (d AND len(p) <> 3) AS wrong_width, count(*) FILTER (d AND contains(v, '�')) AS not_utf8, count(*) FILTER (f AND n IS NULL) AS not_integer, count(*) FILTER (f AND n IS NULL AND regexp_matches(p[2], '(?i)^(freq|count)')) AS header_like, count(*) FILTER (f AND n <= 0) AS not_positive, coalesce(sum(n) FILTER (f AND n > 0), 0)::bigint AS frequency_sum, count(*) FILTER (d) >= 0 AS enough_rows FROM q",
    "bigram_topk": r"WITH w AS (SELECT lang, regexp_extract_all(lower(text), '\p{L}+') AS w FROM documents), p AS (SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: {'previous': w[i], 'current': w[i + 1]}), recursive := true) FROM w), c AS (SELECT lang, previous, current, count(*) AS cnt FROM p GROUP BY ALL), m AS (SELECT *, floor(1000 * cnt / max(cnt) OVER (PARTITION BY lang))::int AS weight, row_number() OVER (PARTITION BY lang, previous ORDER BY cnt DESC, current)::int AS position FROM c) SELECT * FROM m WHERE position <= 3",
    "prefix_top3": rf"WITH {_EN}, p AS (SELECT DISTINCT substr(w, 1, 4) AS prefix FROM (SELECT unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS w FROM benchmark)), r AS (SELECT prefix, word, row_number() OVER (PARTITION BY prefix ORDER BY length(word), word)::int AS position FROM p JOIN en ON starts_with(word, prefix)) SELECT * FROM r WHERE position <= 3",
    "apply_corrections": f"WITH {_FIX}, m AS (SELECT map_from_entries(list((wrong, canonical))) AS m FROM fix), t AS (SELECT doc_id, regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+|[ \\t\\n\\x0B\\f\\r]') AS p FROM documents) SELECT doc_id, md5(array_to_string(list_transform(p, lambda x: coalesce(m[lower(x)], x)), '')) AS corrected_md5, len(list_filter(p, lambda x: m[lower(x)] IS NOT NULL))::int AS n_changed FROM t, m",
    "correction_gate": f"WITH {_FIX}, {_EN}, p AS (SELECT wrong, canonical, unnest(string_split(lower(canonical), ' ')) AS word FROM fix) SELECT DISTINCT wrong, canonical, 'unknown-target' AS error FROM p WHERE word NOT IN (SELECT word FROM en) UNION SELECT wrong, canonical, 'wrong-side-accepted' FROM fix WHERE lower(wrong) IN (SELECT word FROM en)",
    "case_preference": f"WITH {_USES}, c AS (SELECT user_id, key, count(*) FILTER (NOT up) AS l, count(*) FILTER (up) AS u FROM u GROUP BY ALL) SELECT user_id, key, l AS lowercase_uses, u AS capitalized_uses, CASE WHEN u >= 5 AND u - l >= 2 THEN 'capitalized' ELSE 'lowercase' END AS preferred FROM c",
    "windowed_uses": f"WITH {_USES} SELECT strftime(time_bucket(INTERVAL '1 hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, key, count(*) AS uses FROM u GROUP BY ALL",
    "component_surfaces": rf"WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), p AS (SELECT *, regexp_extract_all(regexp_replace(line, '(?i)[''’＇]s\b', '', 'g'), '\p{{L}}+') AS c FROM l) SELECT doc_id, len(c)::int AS n, len(c) > 1 AS multi, array_to_string(c, '|') AS parts, translate(lower(line), '{CFG.marked}', '{CFG.unmarked}') AS folded FROM p",
    "related_forms": rf"""WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS word FROM documents) SELECT 'fold:' || translate(word, '{CFG.marked}', '{CFG.unmarked}') AS "group", string_agg(word, ' ' ORDER BY word) AS forms FROM w GROUP BY 1 HAVING count(*) > 1""",
    "gate_report": "SELECT 'priority-domain' AS gate, count(*) AS violations FROM orders WHERE o_orderpriority IS NULL OR o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') UNION ALL SELECT 'unknown-customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'segment-conflict', count(*) FROM (SELECT c_nationkey FROM customer GROUP BY 1 HAVING count(DISTINCT c_mktsegment) > 1) UNION ALL SELECT 'duplicate-date', count(*) FROM (SELECT o_custkey, o_orderdate FROM orders GROUP BY ALL HAVING count(*) > 1) UNION ALL SELECT 'nation-count', CASE WHEN count(*) = 25 THEN 0 ELSE 1 END FROM nation",
}
