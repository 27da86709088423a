"""Tables that the given data lacks, derived row by row from its words, with the SQL for the same rows.

The corpus has no tags, lemmas or name classes. They are drawn from the MD5 of each word, so every rule of the casing operators meets
rows, and all of them grow with the corpus: a row for each cased form of ``documents`` and ``conversations``, analyses of each of their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions import text as X

_HEX = "0123456789abcdef"
TAGS = (
    "subst:sg:nom:f", "subst:sg:nom:m1", "subst:sg:gen:f", "subst:sg:nom.acc:n", "subst:pl:nom:m1", "adj:sg:nom:m:pos", "fin:sg:ter:imperf", "ign",
    "subst:sg:nom:f", "subst:sg:loc:f", "inf:imperf", "interp", "subst:sg:nom:m3", "adv:pos", "subst:sg:inst:m1", "subst:sg:dat:f",
)
NAME_CLASSES = (
    "", "", "", "", "nazwa_pospolita", "nazwa_pospolita", "nazwisko", "geograficzna+nazwisko", "imię", "nazwa_pospolita+nazwisko", "marka", "geograficzna", "", "", "nazwisko", "imię+nazwisko",
)
STATUS = ("SGJP-LMM-CAPITAL", "SGJP-LMM-UNCAPITAL", "SGJP-LMM-LOWER", "SGJP-BTH-LOWER", *["SGJP-EXACT"] * 12)
KINDS = ("CW", "PN", "ACRO", "WEB", "SPEC", "NEOL", "EXT", "COMPD", *["NCH"] * 8)
CORRECTNESS = ("CORR", "CORR", "CORR", "TAGD", "PLTAN", "TAGE", "DIAL", "ERR", *["CORR"] * 8)
WORD = r"\p{L}+(?:-\p{L}+)*"


def digit(salt: str, word: Column, i: int = 1) -> Column:
    """One of 16 numbers, the same for the same word."""
    return F.instr(F.lit(_HEX), F.substring(F.md5(F.concat(F.lit(salt), word).cast("binary")), i, 1)) - 1


def _digit(salt: str, word: str, i: int = 1) -> str:
    return f"(instr('{_HEX}', substr(md5('{salt}' || {word}), {i}, 1)) - 1)"


def pick(values: tuple[str, ...], at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), at + 1)


def _pick(values: tuple[str, ...], at: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][{at} + 1]"


def _upper(x: str) -> str:
    """Sharp s becomes two letters, as in Spark."""
    return f"replace(upper(replace({x}, 'ß', 'SS')), 'ẞ', 'SS')"


def _upper_first(x: str) -> str:
    return f"({_upper(f'substr({x}, 1, 1)')} || substr({x}, 2))"


def forms(spark: SparkSession, d: str) -> DataFrame:
    """source, form, n: each cased form of both text tables."""
    out = None
    for source in ("documents", "conversations"):
        rows = spark.read.parquet(f"{d}/{source}.parquet").select(F.lit(source).alias("source"), F.explode(F.regexp_extract_all("text", F.lit(f"({WORD})"), 1)).alias("form"))
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("source", "form").agg(F.count("*").alias("n"))


def _stem(key: Column, source: Column) -> Column:
    cut = 1 + F.pmod(digit("s", key), F.lit(2)) + (source == "conversations").cast("int")
    return F.when(F.length(key) > 5, key.substr(F.lit(1), F.length(key) - cut)).otherwise(key)


def tagged(forms: DataFrame) -> DataFrame:
    """form, lemma, tag, frequency, morphology, sgjp_status, classification, correctness."""
    rows = forms.withColumn("key", F.lower("form")).withColumn("stem", _stem(F.col("key"), F.col("source")))
    form, key, stem = map(F.col, ("form", "key", "stem"))
    return rows.select(
        "form", F.when(digit("l", F.concat(form, stem)) < 5, X.upper_first(stem)).otherwise(stem).alias("lemma"), pick(TAGS, digit("t", form)).alias("tag"), F.col("n").alias("frequency"),
        F.concat(F.lit("m"), F.pmod(digit("m", key), F.lit(3)).cast("string")).alias("morphology"), pick(STATUS, digit("u", form)).alias("sgjp_status"), pick(KINDS, digit("k", key)).alias("classification"), pick(CORRECTNESS, digit("c", form)).alias("correctness"),
    )


def analyses(forms: DataFrame) -> DataFrame:
    """orth, lemma, tag, classes: up to two analyses of each key, of its lower-case or its upper-first spelling; a quarter of the keys has none."""
    keys = forms.select(F.lower("form").alias("key")).distinct().where(digit("x", F.col("key")) >= 4)
    out = None
    for salt, share in (("a", 16), ("b", 8)):
        key = F.col("key")
        stem = _stem(key, F.lit("documents"))
        names = pick(NAME_CLASSES, digit(salt, key, 5))
        rows = keys.where(digit(salt, key, 2) < share).select(
            F.when(digit(salt, key, 3) < 5, X.upper_first(key)).otherwise(key).alias("orth"), F.when(digit(salt, key, 6) < 5, X.upper_first(stem)).otherwise(stem).alias("lemma"),
            pick(TAGS, digit(salt, key, 4)).alias("tag"), F.when(names == "", F.array().cast("array<string>")).otherwise(F.split(names, r"\+")).alias("classes"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def policies(forms: DataFrame, salt: str, shares: tuple[int, ...]) -> DataFrame:
    """key, surface, policy: a source of spellings; the i-th draw gives a key a row if its digit is below the i-th share."""
    keys = forms.select(F.lower("form").alias("key")).distinct()
    out = None
    for i, share in enumerate(shares):
        key, at = F.col("key"), F.col("at")
        low = F.pmod(F.floor(at / 2), F.lit(2)) == 0
        rows = keys.withColumn("at", digit(f"{salt}{i}", key)).where(at < share).select("key", F.when(low, key).when(F.pmod(at, F.lit(8)) == 7, F.upper(key)).otherwise(X.upper_first(key)).alias("surface"), F.when(low, "lowercase").otherwise("capitalized").alias("policy"))
        out = rows if out is None else out.unionByName(rows)
    return out


def policies_sql(name: str, salt: str, shares: tuple[int, ...]) -> str:
    draws = []
    for i, share in enumerate(shares):
        at = _digit(f"{salt}{i}", "key")
        low = f"({at} // 2) % 2 = 0"
        draws.append(f"SELECT key, CASE WHEN {low} THEN key WHEN {at} % 8 = 7 THEN {_upper('key')} ELSE {_upper_first('key')} END AS surface, CASE WHEN {low} THEN 'lowercase' ELSE 'capitalized' END AS policy FROM kk WHERE {at} < {share}")
    return f"{name} AS ({' UNION ALL '.join(draws)})"


def _stem_sql(key: str, more: str) -> str:
    return f"CASE WHEN length({key}) > 5 THEN substr({key}, 1, (length({key}) - 1 - {_digit('s', key)} % 2 - {more})::int) ELSE {key} END"


FORMS_SQL = rf"""fo AS (SELECT source, form, count(*) AS n FROM (SELECT 'documents' AS source, unnest(regexp_extract_all(text, '{WORD}')) AS form FROM documents
  UNION ALL SELECT 'conversations', unnest(regexp_extract_all(text, '{WORD}')) FROM conversations) GROUP BY ALL),
kk AS (SELECT DISTINCT lower(form) AS key FROM fo)"""

TAGGED_SQL = f"""tg0 AS (SELECT source, form, n, lower(form) AS key, {_stem_sql('lower(form)', "(source = 'conversations')::int")} AS stem FROM fo),
tg AS (SELECT form, CASE WHEN {_digit('l', 'form || stem')} < 5 THEN {_upper_first('stem')} ELSE stem END AS lemma, {_pick(TAGS, _digit('t', 'form'))} AS tag, n AS frequency,
  'm' || ({_digit('m', 'key')} % 3)::varchar AS morphology, {_pick(STATUS, _digit('u', 'form'))} AS sgjp_status, {_pick(KINDS, _digit('k', 'key'))} AS classification, {_pick(CORRECTNESS, _digit('c', 'form'))} AS correctness FROM tg0),
ok AS (SELECT * FROM tg WHERE correctness IN ('CORR', 'TAGD', 'PLTAN', 'TAGE', 'DIAL') AND frequency > 0 AND form <> '' AND lemma <> '' AND classification <> '')"""


def _analysis_sql(salt: str, share: int) -> str:
    stem = _stem_sql("key", "0")
    return f"""SELECT CASE WHEN {_digit(salt, 'key', 3)} < 5 THEN {_upper_first('key')} ELSE key END AS orth, CASE WHEN {_digit(salt, 'key', 6)} < 5 THEN {_upper(f'substr({stem}, 1, 1)')} || substr({stem}, 2) ELSE {stem} END AS lemma,
  {_pick(TAGS, _digit(salt, 'key', 4))} AS tag, string_split({_pick(NAME_CLASSES, _digit(salt, 'key', 5))}, '+') AS classes FROM kk WHERE {_digit('x', 'key')} >= 4 AND {_digit(salt, 'key', 2)} < {share}"""


#: ``classes`` holds one empty text where there is none.
ANALYSES_SQL = f"an AS ({_analysis_sql('a', 16)} UNION ALL {_analysis_sql('b', 8)})"
