"""Readers (S1-S17). Schemas are explicit; nothing is inferred, codes stay strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.config import LexiconConfig
from wordloom.functions import text as X
from wordloom.functions.records import normalize_gender, parse_count


def _lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path)


def read_wordlist(spark: SparkSession, path) -> DataFrame:
    """Surface; blank and comment lines are dropped."""
    return _lines(spark, path).select(F.trim("value").alias("surface")).where((F.col("surface") != "") & ~F.col("surface").startswith("#"))


def read_core(spark: SparkSession, path, expected: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(key, surface), and its violations: keys with several surfaces, and a size other than expected."""
    rows = read_wordlist(spark, path).withColumn("key", F.lower("surface"))
    keyed = rows.groupBy("key").agg(F.min("surface").alias("surface"), F.count_distinct("surface").alias("n"))
    bad = keyed.where("n > 1").select(F.lit("conflicting-surface").alias("gate"), F.col("key").alias("detail"))
    if expected is not None:
        size = keyed.agg(F.count("*").alias("n")).where(F.col("n") != expected)
        bad = bad.unionByName(size.select(F.lit("size").alias("gate"), F.col("n").cast("string").alias("detail")))
    return keyed.select("key", "surface"), bad


def check_header(found: list[str], wanted: list[str], mode: str = "exact", optional: tuple[str, ...] = ("retention",)) -> None:
    """The three levels of strictness; reads names, never rows."""
    have, need = set(found), set(wanted)
    fine = {"exact": have == need, "superset": need <= have, "exact_plus_optional": need <= have <= need | set(optional)}[mode]
    if not fine or len(have) != len(found):
        raise ValueError(f"header {found} does not fit {wanted} ({mode})")


def find_column(found: list[str], tokens: list[str], unique: bool = True) -> str:
    """A column by folded header token: exactly one match, or the first."""
    keys = [X.normalized_header(t) for t in tokens]
    hits = [c for k in keys for c in found if k in X.normalized_header(c)]
    if not hits or (unique and len(set(hits)) != 1):
        raise ValueError(f"{tokens} match {sorted(set(hits))} of {found}")
    return hits[0]


def read_tsv(spark: SparkSession, path, columns: list[str], mode: str = "exact") -> DataFrame:
    """S3: all strings, header asserted."""
    header = spark.read.text(path).first()
    names = header[0].split("\t") if header else []
    check_header(names, columns, mode)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.csv(path, sep="\t", header=True, schema=schema, quote="", enforceSchema=True)


def read_tsv_commented(spark: SparkSession, path, columns: list[str]) -> DataFrame:
    """As S3, skipping blank lines and comments, also indented ones; the first line left is the header."""
    rows = _lines(spark, path).where((F.trim("value") != "") & ~F.ltrim("value").startswith("#"))
    cells = F.split("value", "\t", -1)
    body = rows.where(F.col("value") != "\t".join(columns))
    return body.select(*(F.get(cells, F.lit(i)).alias(c) for i, c in enumerate(columns)))


def read_families(spark: SparkSession, path, field: int = 2) -> DataFrame:
    """(family, form) of headerless rows with a ``;`` list in one field."""
    cells = F.split("value", "\t", -1)
    rows = _lines(spark, path).where((F.trim("value") != "") & ~F.ltrim("value").startswith("#"))
    forms = rows.select(F.get(cells, F.lit(0)).alias("family"), F.explode(F.split(F.get(cells, F.lit(field)), ";")).alias("form"))
    return forms.select("family", F.trim("form").alias("form")).where("form <> ''")


_KEYBOARD = r"(?:^|[\t ,])word=([^\t ,]+)"


def read_keyboard_list(spark: SparkSession, path, cfg: LexiconConfig = LexiconConfig()) -> DataFrame:
    """Distinct candidate words of ``word=`` records."""
    w = F.lower(F.regexp_extract("value", _KEYBOARD, 1)).alias("word")
    return _lines(spark, path).select(w).where((F.col("word") != "") & X.is_candidate(F.col("word"), cfg)).distinct()


def keyboard_statistics(spark: SparkSession, path, cfg: LexiconConfig = LexiconConfig()) -> DataFrame:
    """Lines, marked lines, plain lines and parsed words, in one pass."""
    w = F.lower(F.regexp_extract("value", _KEYBOARD, 1))
    plain = (F.trim("value") != "") & ~F.col("value").contains("=")
    return _lines(spark, path).agg(F.count("*").alias("lines"), F.count_if(F.col("value").contains("word=")).alias("marked"), F.count_if(plain).alias("plain"), F.count_if((w != "") & X.is_candidate(w, cfg)).alias("parsed"))


TAGGED = ("form", "lemma", "tag", "frequency", "morphology", "sgjp_status", "classification", "correctness")


def read_tagged_frequency(spark: SparkSession, path, least_fields: int = 8) -> DataFrame:
    """Rows with enough fields and a positive frequency."""
    cells = F.split("value", "\t", -1)
    rows = _lines(spark, path).where((F.trim("value") != "") & ~F.ltrim("value").startswith("#")).where(F.size(cells) >= least_fields)
    out = rows.select(*(F.get(cells, F.lit(i)).alias(c) for i, c in enumerate(TAGGED)))
    return out.withColumn("frequency", F.col("frequency").try_cast("long")).where("frequency > 0")


def ranked_vocabulary(counts: DataFrame, language: str, top: int | None = None, cfg: LexiconConfig = LexiconConfig(), keep: tuple[str, ...] = ()) -> DataFrame:
    """S9 over corpus counts (lang, word, cnt): all candidates, or the ``top`` ones by count, with their rank from 0 and the columns to ``keep``."""
    from wordloom.operators.selecting import number_rows

    best = counts.where((F.col("lang") == language) & X.is_candidate(F.col("word"), cfg))
    if top is not None:
        best = best.orderBy(F.desc("cnt"), "word").limit(top)
    return number_rows(best.select("word", "cnt", *keep), [F.desc("cnt"), "word"], "rank").select(F.col("rank").cast("int").alias("rank"), "word", "cnt", *keep)


CORRUPT = "_corrupt_record"


def _xml(spark: SparkSession, path, row_tag: str, schema: T.StructType) -> DataFrame:
    """Rows of an XML source; a row element that is no well-formed XML keeps its text under ``CORRUPT`` and costs no other row.

    The text is split at the elements' end tags, so a large file is read by many tasks and a broken row ends where its element does; each row is then parsed on its own.
    ``row_tag`` and the fields inside may carry a namespace prefix.
    """
    whole = T.StructType([*schema, T.StructField(CORRUPT, T.StringType())])
    chunks = spark.read.option("lineSep", f"</{row_tag}>").text(path)
    bare = row_tag.rsplit(":", 1)[-1]
    # An element without content has no end tag; what is left behind the last one is no row.
    rows = F.regexp_extract_all("value", F.lit(rf"(?s)(<{row_tag}\b[^>]*/>|<{row_tag}\b.*\z)"), 1)
    closed = chunks.select(F.explode(rows).alias("row")).select(F.when(F.col("row").endswith("/>") & ~F.col("row").rlike("(?s)>.*>"), F.col("row")).otherwise(F.concat("row", F.lit(f"</{row_tag}>"))).alias("row"))
    plain = F.regexp_replace("row", r"(</?)[\w.-]+:", "$1")
    options = {"rowTag": bare, "valueTag": "_text", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return closed.select(F.from_xml(plain, whole, options).alias("x")).select("x.*")


def _xml_schema(fields: list[str]) -> T.StructType:
    col = T.StructType([T.StructField(f, T.StringType()) for f in ("_name", "_value", "_text")])
    return T.StructType([*(T.StructField(f, T.StringType()) for f in fields), *(T.StructField(f"_{f}", T.StringType()) for f in fields), T.StructField("col", T.ArrayType(col))])


REGISTRY_FIELDS = ("WOJ", "POW", "GMI", "RODZ", "NAZWA", "NAZDOD", "STAN_NA")


def registry_records(spark: SparkSession, path, fields: tuple[str, ...] = REGISTRY_FIELDS, row_tag: str = "row", required: tuple[str, ...] = ("WOJ", "NAZWA", "NAZDOD")) -> DataFrame:
    """The fields in lower case, ``rejected`` (why a row can't be used, else null) and ``raw`` (its text if it is broken XML).

    A field is a named ``col`` (its ``value`` attribute or its text), the ``col`` in its position where none is named and all are there, a child tag or an attribute; an empty text counts as missing.
    """
    aliases = {"NAZDOD": ("NAZDOD", "NAZWA_DOD")}
    names = sorted({a for f in fields for a in aliases.get(f, (f,))})
    rows = _xml(spark, path, row_tag, _xml_schema(names))
    content = lambda c: F.coalesce(c["_value"], c["_text"])
    named = F.filter("col", lambda c: F.trim(F.coalesce(c["_name"], F.lit(""))) != "")
    placed = F.when((F.size(F.coalesce("col", F.array())) == len(fields)) & (F.size(named) == 0), F.col("col"))

    def called(a: str):  # noqa: ANN202
        return lambda c: F.upper(c["_name"]) == a

    def pick(i: int, field: str):  # noqa: ANN202
        ways = aliases.get(field, (field,))
        by_name = [content(F.get(F.filter(named, called(a)), F.lit(0))) for a in ways]
        found = F.coalesce(*by_name, content(F.get(placed, F.lit(i))), *(F.col(a) for a in ways), *(F.col(f"_{a}") for a in ways))
        return F.nullif(F.trim(found), F.lit("")).alias(field.lower())

    out = rows.select(*(pick(i, f) for i, f in enumerate(fields)), F.col(CORRUPT).alias("raw"))
    lacking = F.coalesce(F.lit(None).cast("string"), *(F.when(F.col(f.lower()).isNull(), f"no-{f.lower()}") for f in required))
    return out.withColumn("rejected", F.when(F.col("raw").isNotNull(), "broken-xml").otherwise(lacking))


def read_registry_xml(spark: SparkSession, path, fields: tuple[str, ...] = REGISTRY_FIELDS, row_tag: str = "row") -> DataFrame:
    """The fields of all rows that are well-formed."""
    return registry_records(spark, path, fields, row_tag, ()).where("rejected is null").drop("rejected", "raw")


def read_gazetteer_xml(spark: SparkSession, path, row_tag: str = "featureMember", name: str = "name", genitive: str = "genitive") -> DataFrame:
    """Name, genitive of features with a name; the elements may carry a namespace prefix."""
    schema = T.StructType([T.StructField(name, T.StringType()), T.StructField(genitive, T.StringType())])
    rows = _xml(spark, path, row_tag, schema)
    return rows.where(F.col(CORRUPT).isNull()).select(F.trim(name).alias("name"), F.coalesce(F.trim(genitive), F.lit("")).alias("genitive")).where("name <> ''")


def read_yearly(spark: SparkSession, path, years: range, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """Name, gender, year, cnt; and the rows that can't be used (``rejected``: name, gender, year or count) with their raw cells.

    The header decides: one column for each of ``years`` (wide), else a year column and a count column (tall). Cells stay texts until they are parsed.
    """
    header = [h.strip().strip('"') for h in (spark.read.text(path).first() or [""])[0].split(sep)]
    table = spark.read.csv(path, sep=sep, header=True, schema=T.StructType([T.StructField(h, T.StringType()) for h in header]))
    name, gender = find_column(header, ["imie", "name"], unique=False), find_column(header, ["plec", "gender"], unique=False)
    wide = [h for h in header if h.isdigit() and int(h) in years]
    if len(set(wide)) == len(years):
        cells = table.select(F.col(name).alias("raw_name"), F.col(gender).alias("raw_gender"), *wide).unpivot(["raw_name", "raw_gender"], wide, "raw_year", "raw_count")
    else:
        year, count = find_column(header, ["rok", "year"], unique=False), find_column(header, ["liczba", "count"], unique=False)
        cells = table.select(F.col(name).alias("raw_name"), F.col(gender).alias("raw_gender"), F.col(year).alias("raw_year"), F.col(count).alias("raw_count"))
    rows = cells.select("*", X.canonical_name(F.col("raw_name")).alias("name"), normalize_gender(F.col("raw_gender")).alias("gender"), F.trim("raw_year").try_cast("int").alias("year"), parse_count(F.col("raw_count")).alias("cnt"))
    why = F.coalesce(*(F.when(F.col(c).isNull(), n) for c, n in (("name", "name"), ("gender", "gender"), ("year", "year"), ("cnt", "count"))))
    judged = rows.withColumn("rejected", why)
    good = judged.where(F.col("rejected").isNull() & F.col("year").between(years.start, years.stop - 1)).groupBy("name", "gender", "year").agg(F.sum("cnt").alias("cnt"))
    return good, judged.where("rejected is not null").select("raw_name", "raw_gender", "raw_year", "raw_count", "rejected")


def yearly_wide(df: DataFrame, name: str, gender: str) -> DataFrame:
    """One column a year -> name, gender, year, cnt."""
    years = [c for c in df.columns if c.isdigit() and len(c) == 4]
    long = df.unpivot([name, gender], years, "year", "raw")
    return long.select(X.canonical_name(F.col(name)).alias("name"), normalize_gender(F.col(gender)).alias("gender"), F.col("year").cast("int").alias("year"), parse_count(F.col("raw").cast("string")).alias("cnt"))


def yearly_tall(df: DataFrame, name: str, count: str, year: int | str, gender: str | None = None, gender_hint: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Sums for each name, and names met with two genders."""
    g = normalize_gender(F.col(gender) if gender else F.lit(None).cast("string"), gender_hint)
    y = F.lit(year) if isinstance(year, int) else F.col(year)
    rows = df.select(X.canonical_name(F.col(name)).alias("name"), g.alias("gender"), y.cast("int").alias("year"), parse_count(F.col(count).cast("string")).alias("cnt")).where("name is not null")
    mixed = rows.groupBy("name", "year").agg(F.count_distinct("gender").alias("genders")).where("genders > 1")
    return rows.groupBy("name", "gender", "year").agg(F.sum("cnt").alias("cnt")), mixed


def population_counts(df: DataFrame, name: str, count: str) -> tuple[DataFrame, DataFrame]:
    """Population by name, and negative or unreadable rows."""
    rows = df.select(X.canonical_name(F.col(name)).alias("name"), parse_count(F.col(count).cast("string"), signed=True).alias("population"), F.input_file_name().alias("file"))
    return rows.where("population >= 0").groupBy("name").agg(F.sum("population").alias("population")), rows.where("population is null or population < 0")


PROFILE = "name string, base string, modules array<string>, priority map<string,double>"


def read_profiles(spark: SparkSession, path) -> DataFrame:
    """S15"""
    return spark.read.schema(PROFILE).json(path, multiLine=True)


def read_snapshot(spark: SparkSession, path, fmt: str = "parquet") -> DataFrame:
    """Key, rank."""
    return spark.read.format(fmt).schema("key string, rank int").load(path)


def corpus_tokens(docs: DataFrame, text: str = "text", lang: str = "lang", keep: tuple[str, ...] = ()) -> DataFrame:
    """Lang, word for each token of a corpus, with the columns to ``keep``."""
    return docs.select(*keep, F.col(lang).alias("lang"), F.explode(X.words(F.col(text))).alias("word"))
