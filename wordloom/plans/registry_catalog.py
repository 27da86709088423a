"""Queries over registries and modules, reviews, profiles' vocabularies, evaluations and file gates."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from wordloom.config import WESTERN
from wordloom.functions import records as R
from wordloom.functions import text as X
from wordloom.operators import casing, counts, coverage, gates, modules, profiles, registry, selecting
from wordloom.plans import derived as D
from wordloom.plans.casing_catalog import _ORDINARY
from wordloom.plans.catalog import _TOKENS, _t, _zipfs
from wordloom.sources import writers

TRIAGED = 500
CFG = replace(WESTERN, common_zipf=5.0)


def _phrases(spark, d):
    """surface, policy, source: each line of a benchmark item or conversation turn that is a short phrase."""
    out = None
    for source in ("benchmark", "conversations"):
        line = _t(spark, d, source).select(F.lit(source).alias("source"), F.explode(F.split("text", r"[.\n]")).alias("surface")).select("source", F.trim("surface").alias("surface"))
        out = line if out is None else out.unionByName(line)
    return out.where(F.length("surface").between(1, 60)).distinct().withColumn("policy", X.case_policy(F.col("surface")))


def component_rows(spark, d):
    """R4, F1, F2, F5, F6, F14."""
    return casing.component_evidence(_phrases(spark, d))


def source_agreement(spark, d):
    """R13 over R4."""
    out = casing.verification(casing.component_evidence(_phrases(spark, d)))
    return out.select("key", F.array_join("source_policies", " ").alias("policies"), F.array_join("sources", " ").alias("sources"), "disagreement")


def _spelled(spark, d, table: str):
    """key, surface: the most frequent spelling of each word, of equally frequent ones the smaller."""
    each = _t(spark, d, table).select(F.explode(X.components(F.col("text"))).alias("surface")).groupBy("surface").agg(F.count("*").alias("n"))
    return each.groupBy(F.lower("surface").alias("key")).agg(F.min(F.struct((-F.col("n")).alias("n"), "surface")).alias("b")).select("key", F.col("b.surface").alias("surface"))


def _policies(spark, d):
    return D.policies(D.forms(spark, d), "v", (4,))


def overridden(spark, d):
    """Spellings of the documents under a table of policies."""
    rows = _spelled(spark, d, "documents").withColumn("policy", X.case_policy(F.col("surface")))
    out = selecting.override(rows, _policies(spark, d))
    return out.withColumn("applied", X.apply_policy(F.col("key"), F.col("policy")))


def merged_modules(spark, d):
    """The documents' audited words, the conversations' and the benchmark's as module; U4: every key has a surface."""
    core = _policies(spark, d).select("key", "surface")
    found, lacking = registry.merge_modules(core, _spelled(spark, d, "conversations"), _spelled(spark, d, "benchmark"))
    return found.unionByName(lacking)


def _forms_of(spark, d, keys):
    """The forms of both text tables whose lower case is among ``keys``, staged: a filter on digests would else be drawn for every token of the corpus."""
    every = D.forms(spark, d)
    return writers.settled(every.join(keys.select("key").distinct(), F.lower("form") == F.col("key"), "left_semi"), "forms-of-keys")


def variant_entries(spark, d):
    """A JSON entry for each word of the benchmark."""
    spelled = _t(spark, d, "benchmark").select(F.explode(X.components(F.col("text"))).alias("surface")).withColumn("key", F.lower("surface"))
    keys = spelled.select("key").distinct()
    return registry.variant_entries(_spelled(spark, d, "benchmark"), spelled, casing.analysis_flags(keys, D.analyses(_forms_of(spark, d, keys))))


def common_homonyms(spark, d):
    """Capitalized words of conversations that are common nouns in lower case."""
    names = _t(spark, d, "conversations").select(F.explode(X.components(F.col("text"))).alias("name")).where(X.starts_upper(F.col("name"))).distinct()
    names = writers.settled(names, "names")
    return casing.homonym_audit(names, D.analyses(_forms_of(spark, d, names.select(F.lower("name").alias("key")))))


def shared_words(spark, d):
    """Words as keys, documents' sources as units."""
    words = _t(spark, d, "documents").select("source", F.explode(X.words(F.col("text"))).alias("name")).distinct()
    return modules.shared_names(words, "name", "source")


def module_pairs(spark, d):
    """The conversations' forms with the counts of form and lemma in the whole corpus."""
    forms = writers.settled(D.forms(spark, d), "forms")
    by_form, by_pair = counts.tagged_counts(selecting.correct_rows(D.tagged(forms)))
    rows = D.tagged(forms.where("source = 'conversations'")).select(F.lit("conversations").alias("module"), F.col("form").alias("surface"), "lemma").distinct()
    return counts.seen_counts(rows, by_form, by_pair)


def triaged(spark, d):
    """Names of the conversations by their population (the customers of a nation whose key fits) and zipf."""
    names = _t(spark, d, "conversations").select(F.lit("spoken").alias("kind"), F.explode(X.components(F.col("text"))).alias("canonical")).where(X.starts_upper(F.col("canonical"))).distinct()
    people = names.where(D.digit("p", F.lower("canonical")) < 6).select(F.lower("canonical").alias("name")).distinct().withColumn("population", (D.digit("p", F.col("name"), 2) * 16 + D.digit("p", F.col("name"), 3)).cast("long"))
    zipfs = _zipfs(spark, d).where("lang = 'fr'").select("word", "zipf")
    return coverage.triage(names, people, zipfs, CFG, TRIAGED)


def profile_words(spark, d):
    """V2, V3: two profiles' vocabularies over the documents' sources as modules, with reviewed priorities."""
    words = _t(spark, d, "documents").select("source", F.explode(X.words(F.col("text"))).alias("word"))
    terms = words.groupBy(F.col("source").alias("module"), "word").agg(F.count("*").cast("int").alias("frequency"))
    spoken = _t(spark, d, "conversations").select(F.explode(X.words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").cast("int").alias("frequency"))
    sources = _t(spark, d, "documents").groupBy().agg(F.sort_array(F.collect_set("source")).alias("s"))
    half = F.transform("s", lambda x: F.struct(x, F.lit(0.5)))
    table = sources.select(F.explode(F.array(F.struct(F.lit("all").alias("name"), F.col("s").alias("modules"), F.map_from_entries(half).alias("priority")), F.struct(F.lit("first").alias("name"), F.slice("s", 1, 1).alias("modules"), F.map_from_entries(F.slice(half, 1, 0)).alias("priority")))).alias("p")).select("p.*")
    scored = profiles.profile_vocabulary(table, terms, spoken)
    asked = _t(spark, d, "benchmark").select(F.explode(X.words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").cast("int").alias("priority")).withColumn("reason", F.lit("benchmark"))
    return profiles.with_priority(scored, asked)


def assembled(spark, d):
    """V4: three layers, the first to hold a word keeps it."""
    layers = {t: _spelled(spark, d, t).select("surface") for t in ("benchmark", "conversations", "documents")}
    return profiles.assemble(layers, keep_first=True)


def ranking_scores(spark, d):
    """V5, V6: guesses of the word after the first of each turn, by two systems; hits by role, and percentiles of their lengths."""
    turns = _t(spark, d, "conversations").withColumn("w", X.words(F.col("text"))).where("size(w) >= 4")
    case = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    gold = turns.select(case.alias("case_id"), F.col("role").alias("grp"), F.col("w")[1].alias("surface")).distinct()
    guesses = None
    for system, place in (("default", (1, 2, 3)), ("turned", (3, 1, 2))):
        g = turns.select(case.alias("case_id"), F.lit(system).alias("system"), F.explode(F.array(*(F.struct(F.lit(i + 1).alias("rank"), F.col("w")[p].alias("surface")) for i, p in enumerate(place)))).alias("g")).select("case_id", "system", "g.rank", "g.surface")
        guesses = g if guesses is None else guesses.unionByName(g)
    return profiles.ranking_evaluation(guesses.distinct(), gold)


def length_percentiles(spark, d):
    """V6"""
    out = profiles.latency_percentiles(_t(spark, d, "conversations").withColumn("ms", F.length("text").cast("double")), ["role"], "ms")
    return out.select("role", "n", F.round("p50", 6).alias("p50"), F.round("p95", 6).alias("p95"))


def file_checks(spark, d):
    """The documents' lines as a file, with its gate and its bytes in the manifest."""
    path = f"{writers.shared_folder(spark)}/lexicon/lines-{uuid.uuid4().hex}"
    lines = _t(spark, d, "documents").select(F.regexp_replace(F.coalesce("text", F.lit("")), "\n", " ").alias("value"))
    lines.write.text(path)
    held = writers.source_manifest(spark, f"{path}/part-*").agg(F.sum("length").alias("bytes"))
    return gates.text_file_gate(spark.read.text(path, lineSep="\n")).crossJoin(held)


def decisions(spark, d):
    """K5: decisions written by class of reason, read back by partition."""
    path = f"{writers.shared_folder(spark)}/lexicon/decisions-{uuid.uuid4().hex}"
    words = _spelled(spark, d, "documents")
    upper, long = X.starts_upper(F.col("surface")), F.length("key") > 12
    reason = F.when(long, F.concat(F.lit("typo->"), F.substring("key", 1, 3))).when(upper, F.concat(F.lit("foreign:"), F.substring("key", 1, 1))).otherwise("spell-evidence")
    writers.write_decisions(words.select(F.col("key").alias("word"), reason.alias("reason")), path)
    return words.sparkSession.read.parquet(path).select("word", "reason", "reason_class")


def reports(spark, d):
    """K3: a JSON text for each language's summary."""
    rows = counts.list_quality(_t(spark, d, "documents").select("lang", F.explode(X.components(F.col("text"))).alias("surface")), by=["lang"])
    return writers.report_json(rows)


def genders(spark, d):
    """speakers' marks as genders and their counts, unreadable rows apart."""
    marks = ("K", "kobieta", "Męska", "m", "żeńska", "?", "MALE", "f")
    rows = _t(spark, d, "customer").select(F.element_at(F.array(*map(F.lit, marks)), (F.pmod("c_custkey", F.lit(8)) + 1).cast("int")).alias("mark"), F.format_number("c_acctbal", 0).alias("raw"))
    count = R.parse_count(F.col("raw"), signed=True)
    return rows.groupBy(F.coalesce(R.normalize_gender(F.col("mark")), F.lit("none")).alias("gender")).agg(F.count("*").alias("n"), F.sum(count).alias("total"), F.count_if(count.isNull() | (count < 0)).alias("bad"))


LISTS = tuple(n for n, _ in (*selecting.DROP_LISTS, *selecting.KEEP_LISTS))


def cascade_lists(spark, d):
    """C1, C2 with every list in force: each word of both text tables is on some of the lists, or on none."""
    forms = writers.settled(D.forms(spark, d), "forms")
    # Staged: each of the lists below reads it.
    words = writers.settled(forms.groupBy(F.lower("form").alias("word")).agg(F.sum("n").alias("cnt")), "words")
    sets = {n: words.where(D.digit(f"l{i}", F.col("word")) == 0).select("word") for i, n in enumerate(LISTS)}
    sets |= {"spell": words.where("cnt >= 2").select("word"), "keyboard": forms.where("source = 'conversations'").select(F.lower("form").alias("word"))}
    rival = words.where(D.digit("f", F.col("word")) < 2).select("word", F.lit("en").alias("rival"))
    typo = words.where(D.digit("g", F.col("word")) < 4).select("word", F.concat("word", F.lit("x")).alias("typo_target"))
    rows = selecting.attach_evidence(words.withColumn("zipf", F.col("cnt").cast("double")), sets, {"rival": rival, "typo_target": typo})
    return selecting.suppress_aliases(selecting.cascade(rows), WESTERN).select("word", "decision", "reason")


def single_tokens(spark, d):
    """The phrases of both tables, by whether they are one token."""
    flagged = selecting.single_token(_phrases(spark, d), "surface")
    good, bad = selecting.split_rejected(flagged, F.col("eligible_single_token"))
    return good.select("source", "surface", F.lit("accepted").alias("outcome")).unionByName(bad.select("source", "surface", F.lit("rejected").alias("outcome")))


def long_corrections(spark, d):
    """J19 with a list too long for a map: every word of the benchmark that begins with a vowel is corrected."""
    wrong = _t(spark, d, "benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("wrong")).where("wrong rlike '^[aeiou]'").distinct()
    out = counts.apply_corrections(_t(spark, d, "conversations"), wrong.withColumn("canonical", F.concat("wrong", F.lit("*"))), key="conv_id", mapped=0)
    return out.select("conv_id", F.md5(F.col("corrected").cast("binary")).alias("corrected_md5"), "n_changed")


QUERIES = {f.__name__: f for f in (cascade_lists, single_tokens, long_corrections, component_rows, source_agreement, overridden, merged_modules, variant_entries, common_homonyms, shared_words, module_pairs, triaged, profile_words, assembled, ranking_scores, length_percentiles, file_checks, decisions, reports, genders)}

_P = r"regexp_extract_all(regexp_replace({c}, '(?i)[''’＇]s\b', '', 'g'), '\p{{L}}+')"
_PARTS = _P.format(c="surface")
_PHRASES = """ph AS (SELECT DISTINCT source, trim(s, ' ') AS surface FROM (SELECT 'benchmark' AS source, unnest(regexp_split_to_array(text, '[.\\n]')) AS s FROM benchmark UNION ALL SELECT 'conversations', unnest(regexp_split_to_array(text, '[.\\n]')) FROM conversations) WHERE length(trim(s, ' ')) BETWEEN 1 AND 60),
hy AS (SELECT *, list_distinct(list_filter(list_transform(regexp_split_to_array(surface, '\\s*,\\s*'), lambda x: trim(x, ' ')), lambda x: regexp_matches(x, '[-‐‑]') AND len(list_filter(regexp_split_to_array(x, '[-‐‑]'), lambda p: trim(p, ' ') <> '')) > 1)) AS h FROM ph),
pa AS (SELECT *, list_concat(@P, list_filter(list_distinct(h), lambda x: NOT list_contains(@P, x))) AS c FROM hy),
ce AS (SELECT source, surface AS phrase, unnest(c) AS component, generate_subscripts(c, 1) AS component_index FROM pa),
cr AS (SELECT lower(component) AS key, component, phrase, component_index::int AS component_index, source, CASE WHEN NOT regexp_matches(phrase, '^\\p{Lu}') OR regexp_matches(component, '^\\p{Ll}') THEN 'lowercase' ELSE 'capitalized' END AS policy FROM ce)""".replace("@P", _PARTS)


def _spelled_sql(name: str, table: str) -> str:
    return f"{name} AS (SELECT lower(s) AS key, arg_min(s, (-n, s)) AS surface FROM (SELECT s, count(*) AS n FROM (SELECT unnest({_P.format(c='text')}) AS s FROM {table}) GROUP BY s) GROUP BY 1)"


_POL = f"{D.FORMS_SQL}, {D.policies_sql('po', 'v', (4,))}"
_FLAGS = ", ".join(f"{D._digit(f'l{i}', 'word')} = 0 AS f{i}" for i in range(len(LISTS)))
_REASONS = " ".join(f"WHEN f{i} THEN '{r}'" for i, (_, r) in enumerate((*selecting.DROP_LISTS, *selecting.KEEP_LISTS)))
_EXEMPT = " OR ".join(f"f{LISTS.index(n)}" for n in selecting.ALIAS_EXEMPT)
_BLANK = " \\t\\n\\x0B\\f\\r"
ORACLE_SQL: dict[str, str] = {
    "cascade_lists": f"""WITH {D.FORMS_SQL}, w AS (SELECT lower(form) AS word, sum(n)::bigint AS cnt, bool_or(source = 'conversations') AS kb FROM fo GROUP BY 1),
e AS (SELECT *, cnt >= 2 AS sp, {D._digit('f', 'word')} < 2 AS rv, {D._digit('g', 'word')} < 4 AS ty, {_FLAGS} FROM w),
c AS (SELECT *, CASE {_REASONS} WHEN rv THEN 'foreign:en' WHEN NOT regexp_matches(word, '[^\\x00-\\x7F]') AND NOT (sp AND kb) THEN 'ascii-without-dual-evidence' WHEN NOT (sp OR kb) AND ty THEN 'typo->' || word || 'x' WHEN NOT (sp OR kb) THEN 'no-positive-evidence' ELSE 'spell-evidence' END AS why FROM e),
k AS (SELECT *, NOT (f0 OR f1 OR f2) AND ({' OR '.join(f'f{i}' for i in range(3, len(LISTS)))} OR why = 'spell-evidence') AS kept, translate(word, '{WESTERN.marked}', '{WESTERN.unmarked}') AS fold, regexp_matches(word, '[{WESTERN.marked}]') AS marked FROM c),
a AS (SELECT fold, arg_min(word, (-cnt, word)) AS accented, arg_min(sp OR kb, (-cnt, word)) AS pos FROM k WHERE kept AND marked GROUP BY fold),
h AS (SELECT k.*, accented, kept AND NOT marked AND NOT (sp OR kb OR {_EXEMPT}) AND coalesce(pos, false) AS hit FROM k LEFT JOIN a USING (fold))
SELECT word, CASE WHEN kept AND NOT hit THEN 'keep' ELSE 'drop' END AS decision, CASE WHEN hit THEN 'diacritic-alias->' || accented ELSE why END AS reason FROM h""",
    "single_tokens": f"WITH {_PHRASES} SELECT source, surface, CASE WHEN regexp_full_match(surface, '\\p{{L}}+') THEN 'accepted' ELSE 'rejected' END AS outcome FROM ph",
    "long_corrections": f"""WITH b AS (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS w FROM benchmark), x AS (SELECT w FROM b WHERE regexp_matches(w, '^[aeiou]')), m AS (SELECT list(w) AS l FROM x),
t AS (SELECT conv_id, turn, regexp_extract_all(text, '[^{_BLANK}]+|[{_BLANK}]') AS p FROM conversations)
SELECT conv_id, md5(array_to_string(list_transform(p, lambda v: CASE WHEN list_contains(l, lower(v)) THEN lower(v) || '*' ELSE v END), '')) AS corrected_md5, len(list_filter(p, lambda v: list_contains(l, lower(v))))::int AS n_changed FROM t, m""",
    "component_rows": f"WITH {_PHRASES} SELECT * FROM cr",
    "source_agreement": f"WITH {_PHRASES} SELECT key, string_agg(DISTINCT policy, ' ' ORDER BY policy) AS policies, string_agg(DISTINCT source, ' ' ORDER BY source) AS sources, count(DISTINCT policy) > 1 AS disagreement FROM cr GROUP BY key",
    "overridden": rf"WITH {_POL}, {_spelled_sql('sp', 'documents')}, x AS (SELECT sp.key, coalesce(po.surface, sp.surface) AS surface, coalesce(po.policy, CASE WHEN regexp_matches(sp.surface, '^\p{{Lu}}') THEN 'capitalized' ELSE 'lowercase' END) AS policy FROM sp LEFT JOIN po ON po.key = sp.key) SELECT *, CASE WHEN policy = 'lowercase' THEN lower(key) ELSE {D._upper_first('key')} END AS applied FROM x",
    "merged_modules": f"WITH {_POL}, {_spelled_sql('b', 'conversations')}, {_spelled_sql('m', 'benchmark')}, k AS (SELECT key FROM po UNION SELECT key FROM b UNION SELECT key FROM m) SELECT k.key, coalesce(po.surface, b.surface, m.surface) AS surface FROM k LEFT JOIN po ON po.key = k.key LEFT JOIN b ON b.key = k.key LEFT JOIN m ON m.key = k.key",
    "variant_entries": f"""WITH {D.FORMS_SQL}, {D.ANALYSES_SQL}, {_spelled_sql('b', 'benchmark')}, v AS (SELECT lower(s) AS key, string_agg(DISTINCT s, '","' ORDER BY s) AS vs FROM (SELECT unnest({_P.format(c='text')}) AS s FROM benchmark) GROUP BY 1),
pr AS (SELECT key, key AS orth FROM b UNION SELECT key, {D._upper_first('key')} FROM b), m0 AS (SELECT key, split_part(tag, ':', 1) AS pos, list_contains(classes, 'nazwa_pospolita') AS c, list_filter(classes, lambda x: x NOT IN ('', 'nazwa_pospolita')) AS names FROM pr JOIN an USING (orth)),
mk AS (SELECT key, bool_or(pos IN {_ORDINARY} AND c) AS is_common, bool_or(pos IN {_ORDINARY} AND len(names) > 0 AND (pos <> 'adj' OR list_contains(names, 'nazwisko'))) AS is_name FROM m0 GROUP BY key)
SELECT b.key, '{{"key":"' || b.key || '","canonicalForm":"' || surface || '","capitalization":{{"default":"' || surface || '","variants":["' || vs || '"]}},"flags":{{' || coalesce('"commonNoun":' || is_common::varchar || ',"properName":' || is_name::varchar, '') || '}}}}' AS entry FROM b JOIN v ON v.key = b.key LEFT JOIN mk ON mk.key = b.key""",
    "common_homonyms": rf"WITH {D.FORMS_SQL}, {D.ANALYSES_SQL}, n AS (SELECT DISTINCT unnest({_P.format(c='text')}) AS name FROM conversations) SELECT name, lower(name) AS key FROM n WHERE regexp_matches(name, '^\p{{Lu}}') AND lower(name) IN (SELECT orth FROM an WHERE orth = lower(orth) AND split_part(tag, ':', 1) = 'subst' AND list_contains(classes, 'nazwa_pospolita'))",
    "shared_words": f"WITH w AS (SELECT DISTINCT source, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS k FROM documents), c AS (SELECT k, count(DISTINCT source) AS n FROM w GROUP BY k) SELECT count(*) AS unique_keys, count(*) FILTER (n > 1) AS shared_keys FROM c",
    "module_pairs": f"""WITH {D.FORMS_SQL}, {D.TAGGED_SQL}, f AS (SELECT lower(form) AS k, sum(frequency)::bigint AS n FROM ok GROUP BY 1), p AS (SELECT lower(form) AS k, lower(lemma) AS l, sum(frequency)::bigint AS n FROM ok GROUP BY ALL),
m AS (SELECT DISTINCT form AS surface, CASE WHEN {D._digit('l', 'form || stem')} < 5 THEN {D._upper_first('stem')} ELSE stem END AS lemma FROM tg0 WHERE source = 'conversations')
SELECT 'conversations' AS module, surface, lemma, lower(surface) AS surface_key, coalesce(f.n, 0) AS surface_count, p.n AS pair_count, coalesce(f.n, 0) > 0 AS seen FROM m LEFT JOIN f ON f.k = lower(surface) LEFT JOIN p ON p.k = lower(surface) AND p.l = lower(lemma)""",
    "triaged": rf"""WITH {_TOKENS}, n AS (SELECT DISTINCT unnest({_P.format(c='text')}) AS canonical FROM conversations), m AS (SELECT 'spoken' AS kind, canonical, lower(canonical) AS key FROM n WHERE regexp_matches(canonical, '^\p{{Lu}}')),
x AS (SELECT m.*, CASE WHEN {D._digit('p', 'key')} < 6 THEN {D._digit('p', 'key', 2)} * 16 + {D._digit('p', 'key', 3)} END AS population, zipf, coalesce(zipf >= 5.0, false) AS common_word_signal FROM m LEFT JOIN (SELECT word, zipf FROM z WHERE lang = 'fr') q ON q.word = m.key)
SELECT * FROM x ORDER BY coalesce(population, 0) DESC, common_word_signal, coalesce(zipf, 0) DESC, canonical LIMIT {TRIAGED}""",
    "profile_words": r"""WITH t AS (SELECT source AS module, word, count(*) AS f FROM (SELECT source, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM documents) GROUP BY ALL), s AS (SELECT word, count(*)::double AS score FROM (SELECT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM conversations) GROUP BY 1),
a AS (SELECT word, count(*)::int AS priority FROM (SELECT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM benchmark) GROUP BY 1),
u AS (SELECT 'all' AS name, word, f * 0.5 AS score FROM t UNION ALL SELECT 'first', word, f::double FROM t WHERE module = (SELECT min(source) FROM documents) UNION ALL SELECT 'all', word, score FROM s UNION ALL SELECT 'first', word, score FROM s),
g AS (SELECT name, word, max(score)::double AS score FROM u GROUP BY ALL) SELECT g.*, coalesce(a.priority, 0) AS priority, CASE WHEN a.word IS NOT NULL THEN 'benchmark' END AS reason FROM g LEFT JOIN a ON a.word = g.word""",
    "assembled": f"WITH {_spelled_sql('a', 'benchmark')}, {_spelled_sql('b', 'conversations')}, {_spelled_sql('c', 'documents')}, u AS (SELECT 0 AS o, 'benchmark' AS layer, * FROM a UNION ALL SELECT 1, 'conversations', * FROM b UNION ALL SELECT 2, 'documents', * FROM c) SELECT layer, surface FROM u QUALIFY row_number() OVER (PARTITION BY key ORDER BY o, surface) = 1",
    "ranking_scores": r"""WITH t AS (SELECT conv_id, turn, role, list_filter(string_split_regex(lower(text), '[^\p{L}]+'), lambda x: x <> '') AS w FROM conversations), c AS (SELECT DISTINCT * FROM t WHERE len(w) >= 4),
h AS (SELECT 'default' AS system, role AS grp, w[2] = w[2] AS t1, true AS t3, true AS base FROM c UNION ALL SELECT 'turned', role, w[4] = w[2], true, true FROM c)
SELECT system, grp, count(*) AS cases, count(*) FILTER (t1) AS top1, count(*) FILTER (t3) AS top3, count(*) FILTER (t1 AND NOT base) AS fixed, count(*) FILTER (NOT t1 AND base) AS broken FROM h GROUP BY ALL""",
    "length_percentiles": "SELECT role, count(*) AS n, round(quantile_cont(length(text)::double, 0.5), 6) AS p50, round(quantile_cont(length(text)::double, 0.95), 6) AS p95 FROM conversations GROUP BY role",
    "file_checks": r"""WITH l AS (SELECT replace(coalesce(text, ''), chr(10), ' ') AS v FROM documents), c AS (SELECT count(*) AS lines, count(*) FILTER (contains(v, chr(13))) AS carriage_returns, count(*) FILTER (regexp_matches(v, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]')) AS controls, sum(strlen(v) + 1)::bigint AS bytes FROM l) SELECT *, lines > 0 AND carriage_returns = 0 AND controls = 0 AS ok FROM c""",
    "decisions": rf"WITH {_spelled_sql('s', 'documents')}, r AS (SELECT key AS word, CASE WHEN length(key) > 12 THEN 'typo->' || substr(key, 1, 3) WHEN regexp_matches(surface, '^\p{{Lu}}') THEN 'foreign:' || substr(key, 1, 1) ELSE 'spell-evidence' END AS reason FROM s) SELECT *, split_part(split_part(reason, '->', 1), ':', 1) AS reason_class FROM r",
    "reports": f"""WITH w AS (SELECT lang, unnest({_P.format(c='text')}) AS s FROM documents), q AS (SELECT lang, count(*) AS e, count(DISTINCT lower(s)) AS u FROM w GROUP BY lang) SELECT '{{"lang":"' || lang || '","entries":' || e || ',"unique_keys":' || u || ',"duplicates":' || (e - u) || '}}' AS value FROM q""",
    "genders": "WITH r AS (SELECT ['F', 'F', 'M', 'M', 'F', 'none', 'M', 'F'][c_custkey % 8 + 1] AS gender, round_even(c_acctbal, 0)::bigint AS c FROM customer) SELECT gender, count(*) AS n, sum(c)::bigint AS total, count(*) FILTER (c < 0) AS bad FROM r GROUP BY gender",
}
