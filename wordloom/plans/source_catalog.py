"""Queries that write the given tables in the sources' formats and read them back through the readers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wordloom.config import WESTERN
from wordloom.functions import records as R
from wordloom.functions import text as X
from wordloom.operators import coverage, gates, profiles, selecting
from wordloom.plans import derived as D
from wordloom.plans.catalog import _t
from wordloom.sources import readers, writers

YEARS = range(1990, 2010)
_KINDS = ("województwo", "powiat", "miasto na prawach powiatu", "gmina miejska", "gmina wiejska", "osada", "")


def _scratch(spark, name: str) -> str:
    return f"{writers.shared_folder(spark)}/lexicon/{name}-{uuid.uuid4().hex}"


def _units(spark, d):
    """Customers as rows of a registry."""
    key = F.col("c_custkey")
    at = F.pmod(key, F.lit(7))
    kind = F.element_at(F.array(*map(F.lit, _KINDS)), (at + 1).cast("int"))
    code = lambda n: F.lpad((F.pmod(key, F.lit(n)) + 1).cast("string"), 2, "0")
    level = F.when(at == 0, 0).when(at < 3, 1).otherwise(2)
    return _t(spark, d, "customer").select(
        key.alias("k"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("WOJ"), F.when(level > 0, code(40)).otherwise("").alias("POW"), F.when(level > 1, code(90)).otherwise("").alias("GMI"), F.when(level > 1, (F.pmod(key, F.lit(4)) + 1).cast("string")).otherwise("").alias("RODZ"),
        F.when(F.pmod(key, F.lit(11)) == 0, "").otherwise(F.initcap("c_mktsegment")).alias("NAZWA"), kind.alias("NAZDOD"), F.lit("2020-01-01").alias("STAN_NA"),
    )


def registry_units(spark, d):
    """Four encodings of a row and broken rows in one folder; units with their level and code, rejected rows counted by reason."""
    units = _units(spark, d)
    path = _scratch(spark, "registry")
    fields = list(readers.REGISTRY_FIELDS)
    cell = lambda f, name, text: F.concat(F.lit(f'<col name="{name}"'), *([F.lit(' value="'), F.col(f), F.lit('"/>')] if not text else [F.lit(">"), F.col(f), F.lit("</col>")]))
    bodies = [
        F.concat(F.lit("<row>"), *(F.concat(F.lit(f"<{f}>"), F.col(f), F.lit(f"</{f}>")) for f in fields), F.lit("</row>")),
        F.concat(F.lit("<row"), *(F.concat(F.lit(f' {f}="'), F.col(f), F.lit('"')) for f in fields), F.lit("><x/></row>")),
        F.concat(F.lit("<row>"), *(cell(f, "NAZWA_DOD" if f == "NAZDOD" else f.lower(), i % 2) for i, f in enumerate(fields)), F.lit("</row>")),
        F.concat(F.lit("<row>"), *(F.concat(F.lit("<col>"), F.col(f), F.lit("</col>")) for f in fields), F.lit("</row>")),
        F.concat(F.lit("<row><WOJ>"), F.col("WOJ"), F.lit("</NAZWA></row>")),
    ]
    body = bodies[-1]
    for i, b in enumerate(bodies[:-1]):
        body = F.when(F.pmod("k", F.lit(9)) % 5 == i, b).otherwise(body)
    units.select(body.alias("value")).write.text(path)
    rows = readers.registry_records(spark, path)
    level = R.classify_level(F.col("woj"), F.col("pow"), F.col("gmi"), F.col("rodz"), F.col("nazdod"))
    judged = rows.withColumn("level", level).withColumn("outcome", F.coalesce("rejected", F.when(F.col("level").isNull(), "lower-level"), F.lit("unit")))
    unit = R.canonical_unit(F.col("nazwa"), F.col("level"), F.col("nazdod"))
    used = F.col("outcome") == "unit"
    out = judged.select("outcome", "level", F.when(used, R.unit_code(*map(F.col, ("woj", "pow", "gmi", "rodz")))).alias("code"), F.when(used, unit["surface"]).alias("surface"), F.when(used, unit["policy"]).alias("policy"), F.when(used, F.when(F.col("nazwa").rlike(r"^\p{L}+$"), "yes").otherwise("no")).alias("single"))
    return out.withColumn("level", F.when(used, F.col("level"))).groupBy("outcome", "level", "code", "surface", "policy", "single").agg(F.count("*").alias("n"))


def gazetteer_names(spark, d):
    """Parts as features of a gazetteer, some without a name or a genitive."""
    key, path = F.col("p_partkey"), _scratch(spark, "gazetteer")
    name, gen = F.when(key % 13 == 0, " ").otherwise(F.concat(F.lit(" "), F.col("p_name"))), F.when(key % 5 == 0, "").otherwise(F.concat(F.lit("<genitive>"), F.col("p_brand"), F.lit(" </genitive>")))
    _t(spark, d, "part").select(F.concat(F.lit("<featureMember><name>"), name, F.lit("</name>"), gen, F.lit("</featureMember>")).alias("value")).write.text(path)
    return readers.read_gazetteer_xml(spark, path).groupBy("name", "genitive").agg(F.count("*").alias("n"))


def _sold(spark, d):
    """Orders by market segment, half of the nations and year."""
    o, c = _t(spark, d, "orders"), _t(spark, d, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).groupBy(F.concat("c_mktsegment", F.when(F.col("c_nationkey") == 3, "7").otherwise("")).alias("name"), F.element_at(F.array(*map(F.lit, ("K", "mężczyzna", "?"))), (F.least(F.col("c_nationkey") % 9, F.lit(2)) + 1).cast("int")).alias("gender"), F.year("o_orderdate").alias("year")).agg(F.count("*").alias("cnt"))


def yearly_wide_source(spark, d):
    """A column for each year, written as CSV and read back; rejected cells by reason."""
    path = _scratch(spark, "yearly-wide")
    text = F.concat(F.format_number("cnt", 0), F.when(F.col("cnt") % 17 == 0, "x").otherwise(""))
    wide = _sold(spark, d).groupBy(F.col("name").alias("Imię"), F.col("gender").alias("Płeć")).pivot("year", list(YEARS)).agg(F.first(text))
    wide.write.csv(path, header=True)
    return _both(*readers.read_yearly(spark, path, YEARS))


def yearly_tall_source(spark, d):
    """The same as one row for each name and year."""
    path = _scratch(spark, "yearly-tall")
    sold = _sold(spark, d)
    year = F.when(F.col("cnt") % 19 == 0, "n/a").otherwise(F.col("year").cast("string"))
    sold.select(F.col("name").alias("IMIE"), F.col("gender").alias("PLEC"), year.alias("Rok"), F.format_number("cnt", 0).alias("Liczba")).write.csv(path, header=True)
    return _both(*readers.read_yearly(spark, path, YEARS))


def _both(good, bad):
    none = F.lit(None).cast("string")
    lost = bad.groupBy("rejected").agg(F.count("*").alias("cnt"))
    return good.select("name", "gender", "year", "cnt", none.alias("rejected")).unionByName(lost.select(none.alias("name"), none.alias("gender"), F.lit(None).cast("int").alias("year"), "cnt", "rejected"))


def tagged_source(spark, d):
    """The tagged corpus as its tab-separated file with comments, short and unreadable rows."""
    path = _scratch(spark, "tagged")
    rows = D.tagged(D.forms(spark, d))
    at = D.digit("q", F.col("form"))
    count = F.when(at == 0, "x").when(at == 1, "0").otherwise(F.col("frequency").cast("string"))
    line = F.concat_ws("\t", "form", "lemma", "tag", count, "morphology", "sgjp_status", "classification", F.when(at == 2, F.lit(None)).otherwise(F.col("correctness")))
    rows.select(F.when(at == 3, F.concat(F.lit("  # "), line)).otherwise(line).alias("value")).write.text(path)
    return selecting.correct_rows(readers.read_tagged_frequency(spark, path)).select("form", "lemma", "tag", "frequency", "sgjp_status", "classification")


def core_source(spark, d):
    """S1, S2 over K1: a word list with counts in its head and conflicting spellings."""
    path = _scratch(spark, "core")
    writers.write_wordlist(_t(spark, d, "documents").select(F.explode(X.components(F.col("text"))).alias("surface")).distinct(), path, counts={"surfaces": F.count("*")})
    core, bad = readers.read_core(spark, path, 7)
    marks = bad.groupBy("gate").agg(F.count("*").alias("n"), F.min("detail").alias("first"))
    return marks.unionByName(core.agg(F.count("*").alias("n"), F.min("surface").alias("first")).withColumn("gate", F.lit("keys")))


def keyboard_source(spark, d):
    """A keyboard's list, as two tables in one: its words and its statistics."""
    path = _scratch(spark, "keyboard")
    words = _t(spark, d, "conversations").select(F.explode(F.split("text", " ")).alias("w")).where("w <> ''").groupBy("w").agg(F.count("*").alias("n"))
    line = F.when(F.col("n") % 7 == 0, F.col("w")).when(F.col("n") % 11 == 0, F.concat(F.lit("dictionary="), F.col("w"))).otherwise(F.concat(F.lit(" word="), F.col("w"), F.lit(",f="), F.col("n").cast("string")))
    words.select(F.regexp_replace(line, r"[\r\n]", "").alias("value")).write.text(path)
    found = readers.read_keyboard_list(spark, path, WESTERN).select("word", F.lit(None).cast("long").alias("n"))
    stats = readers.keyboard_statistics(spark, path, WESTERN)
    return found.unionByName(stats.select(F.explode(F.map_from_arrays(F.array(*(F.lit(f"#{c}") for c in stats.columns)), F.array(*stats.columns))).alias("word", "n")))


def families_source(spark, d):
    """S4, S5 over K2: each stem with the list of its forms."""
    path, again = _scratch(spark, "families"), _scratch(spark, "families-rows")
    forms = D.forms(spark, d).select(F.lower("form").alias("form")).distinct()
    family = forms.groupBy(F.substring("form", 1, 3).alias("family")).agg(F.count("*").alias("size"), F.sort_array(F.collect_set(F.substring("form", 4, 2))).alias("ends"))
    body = F.concat_ws("\t", "family", F.col("size").cast("string"), F.array_join("ends", " ; "))
    family.select(F.when(F.col("size") == 2, F.concat(F.lit(" # "), body)).otherwise(body).alias("value")).write.text(path)
    writers.write_tsv(family, again, ["family", "size"], ["family"])
    sizes = readers.read_tsv_commented(spark, again, ["family", "size"]).groupBy("family").agg(F.max("size").alias("size"))
    return readers.read_families(spark, path).join(sizes, "family", "left")


def profiles_source(spark, d):
    """A profile for each nation on top of its region's, written as a JSON file, which is one text, and resolved."""
    path = _scratch(spark, "profiles")
    region = _t(spark, d, "region").select(F.col("r_name").alias("name"), F.lit(None).cast("string").alias("base"), F.array(F.lit("core"), F.lower("r_name")).alias("modules"), F.create_map(F.lit("core"), F.col("r_regionkey").cast("double")).alias("priority"))
    n, r = _t(spark, d, "nation"), _t(spark, d, "region")
    nation = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_name").alias("name"), F.col("r_name").alias("base"), F.array(F.lower("n_name"), F.lit("core")).alias("modules"), F.create_map(F.when(F.col("n_nationkey") % 2 == 0, "core").otherwise(F.lower("n_name")), F.col("n_nationkey").cast("double")).alias("priority"))
    region.unionByName(nation).agg(F.to_json(F.collect_list(F.struct("name", "base", "modules", "priority"))).alias("value")).write.text(path)
    out = profiles.resolve_profiles(readers.read_profiles(spark, path))
    return out.select("name", "depth", F.array_join("modules", " ").alias("modules"), F.try_element_at("priority", F.lit("core")).alias("core"), F.size("priority").alias("priorities"))


def snapshot_source(spark, d):
    """Two rankings of the documents' words, kept as CSV and as Parquet, compared."""
    words = _t(spark, d, "documents").select("doc_id", F.explode(X.words(F.col("text"))).alias("key"))
    ranked = lambda rows: selecting.number_rows(rows.groupBy("key").agg(F.count("*").alias("cnt")), [F.desc("cnt"), F.col("key")], "rank").select("key", F.col("rank").cast("int").alias("rank"))
    old, new = _scratch(spark, "snapshot-old"), _scratch(spark, "snapshot-new")
    ranked(words).write.csv(old)
    ranked(words.where(F.length("key") > 3)).write.parquet(new)
    return coverage.snapshot_diff(readers.read_snapshot(spark, old, "csv"), readers.read_snapshot(spark, new)).select("key", "change", "old_rank", "new_rank")


def population_source(spark, d):
    """customers' balances as populations, with the rows that can't be used."""
    path = _scratch(spark, "population")
    _t(spark, d, "customer").select(F.when(F.col("c_custkey") % 10 == 0, "No 1").otherwise(F.col("c_mktsegment")).alias("name"), F.when(F.col("c_custkey") % 13 == 0, "many").otherwise(F.format_number("c_acctbal", 0)).alias("n")).write.csv(path, header=True)
    good, bad = readers.population_counts(spark.read.csv(path, header=True, schema="name string, n string"), "name", "n")
    return good.unionByName(bad.groupBy(F.when(F.col("population").isNull(), "unreadable").otherwise("negative").alias("name")).agg(F.count("*").alias("population")))


def tsv_source(spark, d):
    """S3, K2: the benchmark's words as a checked table."""
    path = _scratch(spark, "tsv")
    words = _t(spark, d, "benchmark").select("item_id", F.explode(X.words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("uses"), F.min("item_id").alias("first"))
    writers.write_tsv(words, path, ["word", "uses", "first"], ["word"])
    return readers.read_tsv(spark, path, ["word", "uses", "first"])


def corrections_source(spark, d):
    """reviewed corrections as lines, some of them not well-formed."""
    w = F.slice(F.split("text", " "), 1, 2)
    line = _t(spark, d, "conversations").select(F.concat(F.lit(" "), F.array_join(w, " -> ")).alias("a"), (F.col("turn") % 3).alias("t"))
    line = line.select(F.when(F.col("t") == 1, F.replace("a", F.lit(" -> "), F.lit("->"))).when(F.col("t") == 2, F.replace("a", F.lit(" -> "), F.lit(" "))).otherwise(F.col("a")).alias("line"))
    p = R.parse_correction(F.col("line"))
    return line.select(p["wrong"].alias("wrong"), p["canonical"].alias("canonical")).groupBy("wrong", "canonical").agg(F.count("*").alias("n"))


def inflection_surfaces(spark, d):
    """the phrases of benchmark and conversations by the shape of their surface."""
    text = F.explode(F.split("text", r"[.\n]")).alias("x")
    rows = _t(spark, d, "benchmark").select(text).unionByName(_t(spark, d, "conversations").select(text)).select(F.trim("x").alias("surface")).where("surface <> ''")
    rows = rows.unionByName(rows.select(F.replace("surface", F.lit(" "), F.lit("-")).alias("surface"))).distinct()
    return rows.select("surface", X.is_inflection_surface(F.col("surface")).alias("inflection"), X.is_hyphenated(F.col("surface")).alias("hyphenated"))


def evidence_overlap(spark, d):
    """The union of two evidence sets and its overlap with a third."""
    words = lambda t: _t(spark, d, t).select(F.explode(X.words(F.col("text"))).alias("word"))
    return gates.overlap(gates.evidence_union(words("benchmark"), words("conversations")), words("documents"))


QUERIES = {f.__name__: f for f in (profiles_source, snapshot_source, population_source, tsv_source, corrections_source, inflection_surfaces, evidence_overlap, registry_units, gazetteer_names, yearly_wide_source, yearly_tall_source, tagged_source, core_source, keyboard_source, families_source)}

_KIND_LIST = "[" + ", ".join(f"'{k}'" for k in _KINDS) + "]"
_SOLD = """so AS (SELECT c_mktsegment || CASE WHEN c_nationkey = 3 THEN '7' ELSE '' END AS name, ['F', 'M', NULL][least(c_nationkey % 9, 2) + 1] AS gender, year(o_orderdate)::int AS year, count(*) AS cnt FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""
_NAMED = "upper(substr(name, 1, 1)) || lower(substr(name, 2))"


def _yearly(bad: str, cells: str, reason: str) -> str:
    return f"""WITH {_SOLD}, ce AS ({cells}), ju AS (SELECT *, CASE WHEN regexp_matches(name, '[0-9]') THEN 'name' WHEN gender IS NULL THEN 'gender' WHEN {bad} THEN '{reason}' END AS rejected FROM ce)
SELECT {_NAMED} AS name, gender, year, cnt, NULL AS rejected FROM ju WHERE rejected IS NULL AND year BETWEEN {YEARS.start} AND {YEARS.stop - 1} UNION ALL SELECT NULL, NULL, NULL, count(*), rejected FROM ju WHERE rejected IS NOT NULL GROUP BY rejected"""


_SURFACES = r"SELECT DISTINCT unnest(regexp_extract_all(regexp_replace(text, '(?i)[''’＇]s\b', '', 'g'), '\p{L}+')) AS s FROM documents"
_LETTERS = f"[{WESTERN.alphabet}]+"
_LINES = "SELECT unnest(regexp_split_to_array(text, '[.\\n]')) AS x FROM"
_WORDS = "SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS w FROM"
ORACLE_SQL: dict[str, str] = {
    "profiles_source": """SELECT r_name AS name, 0 AS depth, 'core ' || lower(r_name) AS modules, r_regionkey::double AS core, 1 AS priorities FROM region
UNION ALL SELECT n_name, 1, 'core ' || lower(r_name) || ' ' || lower(n_name), CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey ELSE r_regionkey END::double, CASE WHEN n_nationkey % 2 = 0 THEN 1 ELSE 2 END FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "snapshot_source": r"""WITH c AS (SELECT key, count(*) AS cnt FROM (SELECT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS key FROM documents) GROUP BY key), a AS (SELECT key, (row_number() OVER (ORDER BY cnt DESC, key) - 1)::int AS old_rank FROM c), b AS (SELECT key, (row_number() OVER (ORDER BY cnt DESC, key) - 1)::int AS new_rank FROM c WHERE length(key) > 3),
d AS (SELECT key, CASE WHEN new_rank IS NULL THEN 'removed' WHEN old_rank <> new_rank THEN 'rank_changed' END AS change, old_rank, new_rank FROM a LEFT JOIN b USING (key)) SELECT * FROM d WHERE change IS NOT NULL""",
    "population_source": """WITH r AS (SELECT CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) END AS name, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE round_even(c_acctbal, 0)::bigint END AS n FROM customer)
SELECT name, sum(n)::bigint AS population FROM r WHERE n >= 0 GROUP BY name UNION ALL SELECT CASE WHEN n IS NULL THEN 'unreadable' ELSE 'negative' END, count(*) FROM r WHERE n IS NULL OR n < 0 GROUP BY 1""",
    "tsv_source": r"SELECT word, count(*)::varchar AS uses, min(item_id)::varchar AS first FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM benchmark) GROUP BY word",
    "corrections_source": """WITH w AS (SELECT turn, string_split(text, ' ')[1:2] AS w FROM conversations), p AS (SELECT CASE WHEN turn % 3 < 2 AND len(w) = 2 THEN w[1] END AS wrong, CASE WHEN turn % 3 < 2 AND len(w) = 2 THEN w[2] END AS canonical FROM w) SELECT *, count(*) AS n FROM p GROUP BY ALL""",
    "inflection_surfaces": rf"""WITH l AS (SELECT trim(x, ' ') AS s FROM ({_LINES} benchmark UNION ALL {_LINES} conversations)), u AS (SELECT s AS surface FROM l WHERE s <> '' UNION SELECT replace(s, ' ', '-') FROM l WHERE s <> '')
SELECT surface, regexp_full_match(surface, '\p{{L}}+') OR regexp_full_match(surface, '\p{{L}}+(?: \p{{L}}+)*(?:[-‐‑]\p{{L}}+(?: \p{{L}}+)*)+') AS inflection, regexp_matches(surface, '[-‐‑]') AND len(list_filter(regexp_split_to_array(surface, '[-‐‑]'), lambda p: trim(p, ' ') <> '')) > 1 AS hyphenated FROM u""",
    "evidence_overlap": f"WITH a AS ({_WORDS} benchmark UNION {_WORDS} conversations), b AS ({_WORDS} documents) SELECT (SELECT count(*) FROM a) AS n_a, (SELECT count(*) FROM b) AS n_b, (SELECT count(*) FROM a SEMI JOIN b USING (w)) AS n_both, (SELECT count(*) FROM a ANTI JOIN b USING (w)) AS only_a, (SELECT count(*) FROM b ANTI JOIN a USING (w)) AS only_b",
    "registry_units": f"""WITH u AS (SELECT c_custkey AS k, c_custkey % 7 AS t, lpad(c_nationkey::varchar, 2, '0') AS woj, lpad((c_custkey % 40 + 1)::varchar, 2, '0') AS pow, lpad((c_custkey % 90 + 1)::varchar, 2, '0') AS gmi, c_custkey % 4 + 1 AS rodz,
  CASE WHEN c_custkey % 11 = 0 THEN '' ELSE upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) END AS nazwa, {_KIND_LIST}[c_custkey % 7 + 1] AS kind FROM customer),
v AS (SELECT *, CASE WHEN k % 9 % 5 = 4 THEN 'broken-xml' WHEN nazwa = '' THEN 'no-nazwa' WHEN kind = '' THEN 'no-nazdod' WHEN t = 0 OR t IN (1, 2) THEN 'unit' WHEN t IN (3, 4) AND rodz <= 3 THEN 'unit' ELSE 'lower-level' END AS outcome FROM u),
w AS (SELECT outcome, CASE WHEN outcome = 'unit' THEN ['voivodeship', 'powiat', 'powiat', 'gmina', 'gmina'][t + 1] END AS level, CASE WHEN outcome = 'unit' THEN woj || CASE WHEN t > 0 THEN pow ELSE '' END || CASE WHEN t > 2 THEN gmi || rodz::varchar ELSE '' END END AS code,
  CASE WHEN outcome = 'unit' THEN CASE WHEN t < 2 THEN lower(nazwa) ELSE nazwa END END AS surface, CASE WHEN outcome = 'unit' THEN CASE WHEN t < 2 THEN 'lowercase' ELSE 'capitalized' END END AS policy, CASE WHEN outcome = 'unit' THEN 'yes' END AS single FROM v)
SELECT *, count(*) AS n FROM w GROUP BY ALL""",
    "gazetteer_names": "SELECT p_name AS name, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_brand END AS genitive, count(*) AS n FROM part WHERE p_partkey % 13 <> 0 GROUP BY ALL",
    "yearly_wide_source": _yearly("cnt > 0 AND real % 17 = 0", f"SELECT p.name, p.gender, y.year, coalesce(so.cnt, 0) AS cnt, so.cnt AS real FROM (SELECT DISTINCT name, gender FROM so) p CROSS JOIN (SELECT unnest(range({YEARS.start}, {YEARS.stop}))::int AS year) y LEFT JOIN so ON so.name = p.name AND so.gender IS NOT DISTINCT FROM p.gender AND so.year = y.year", "count"),
    "yearly_tall_source": _yearly("cnt % 19 = 0", "SELECT * FROM so", "year"),
    "tagged_source": f"WITH {D.FORMS_SQL}, {D.TAGGED_SQL} SELECT form, lemma, tag, frequency, sgjp_status, classification FROM ok WHERE {D._digit('q', 'form')} > 3",
    "core_source": f"""WITH s AS ({_SURFACES}), k AS (SELECT lower(s) AS key, min(s) AS surface, count(*) AS n FROM s GROUP BY 1)
SELECT 'keys' AS gate, count(*) AS n, min(surface) AS first FROM k UNION ALL SELECT 'conflicting-surface', count(*), min(key) FROM k WHERE n > 1 UNION ALL SELECT 'size', 1, count(*)::varchar FROM k HAVING count(*) <> 7""",
    "keyboard_source": rf"""WITH w AS (SELECT w, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS w FROM conversations) WHERE w <> '' GROUP BY w),
l AS (SELECT regexp_replace(CASE WHEN n % 7 = 0 THEN w WHEN n % 11 = 0 THEN 'dictionary=' || w ELSE ' word=' || w || ',f=' || n::varchar END, '[\r\n]', '', 'g') AS v FROM w),
p AS (SELECT v, lower(regexp_extract(v, '(?:^|[\t ,])word=([^\t ,]+)', 1)) AS word FROM l),
q AS (SELECT *, word <> '' AND length(word) BETWEEN 1 AND 25 AND regexp_full_match(word, '{_LETTERS}') AS good FROM p)
SELECT DISTINCT word, NULL::bigint AS n FROM q WHERE good UNION ALL SELECT '#lines', count(*) FROM q UNION ALL SELECT '#marked', count(*) FROM q WHERE contains(v, 'word=') UNION ALL SELECT '#plain', count(*) FROM q WHERE trim(v, ' ') <> '' AND NOT contains(v, '=') UNION ALL SELECT '#parsed', count(*) FROM q WHERE good""",
    "families_source": f"""WITH {D.FORMS_SQL}, f AS (SELECT substr(key, 1, 3) AS family, count(*) AS size, list(DISTINCT substr(key, 4, 2)) AS ends FROM kk GROUP BY 1)
SELECT family, trim(e) AS form, size::varchar AS size FROM (SELECT family, size, unnest(ends) AS e FROM f WHERE size <> 2) WHERE trim(e) <> ''""",
}
