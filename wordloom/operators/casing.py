"""Casing evidence and resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.config import LexiconConfig
from wordloom.functions import text as X
from wordloom.sources.writers import settled

# Statuses and classes of the tagged corpus.
CAPITAL_STATUS = ("SGJP-LMM-CAPITAL",)
LOWER_STATUS = ("SGJP-LMM-UNCAPITAL", "SGJP-LMM-LOWER", "SGJP-BTH-LOWER")
PROPER_CLASSES = ("PN", "ACRO", "WEB")
LEXICAL_CLASSES = ("SPEC", "NEOL", "EXT", "SYMB", "COMPD")
# The class of common nouns, the parts of speech that names and common nouns have, and the class of family names.
COMMON_CLASS = "nazwa_pospolita"
ORDINARY_POS = ("subst", "adj", "adv", "verb", "part", "prep", "conj", "num", "ger", "ppron", "pron")
SURNAME = "nazwisko"
DIMENSIONS = {"forms": "form", "lemmas": "lemma", "tags": "tag", "classes": "classification", "sgjp_status": "sgjp_status", "correctness": "correctness", "morphology": "morphology"}


def evidence_long(tagged: DataFrame, by: str = "form") -> DataFrame:
    """A3: key, dim, value, n: one long table and one shuffle for all counters. ``by``: form or lemma."""
    pairs = F.array(*(F.struct(F.lit(d).alias("dim"), F.col(c).alias("value")) for d, c in DIMENSIONS.items()))
    long = tagged.select(F.lower(by).alias("key"), "frequency", F.explode(pairs).alias("x"))
    return long.select("key", "frequency", "x.dim", "x.value").where("value <> ''").groupBy("key", "dim", "value").agg(F.sum("frequency").alias("n"))


def evidence_maps(long: DataFrame) -> DataFrame:
    """A3: key with one map for each dimension."""
    m = F.map_from_entries(F.sort_array(F.collect_list(F.struct("value", "n"))))
    return long.groupBy("key").pivot("dim", sorted(DIMENSIONS)).agg(m)


def case_weights(long: DataFrame, dim: str = "forms") -> DataFrame:
    """A4: upper-first and lower-first weight of each key."""
    up, low = X.starts_upper(F.col("value")), X.starts_lower(F.col("value"))
    return long.where(F.col("dim") == dim).groupBy("key").agg(F.coalesce(F.sum(F.when(up, F.col("n"))), F.lit(0)).alias("upper"), F.coalesce(F.sum(F.when(low, F.col("n"))), F.lit(0)).alias("lower"))


def secondary_verdict(long: DataFrame) -> DataFrame:
    """Key, surface, policy, basis; keys without a verdict are absent. Ties fall through to the next rule."""
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0))
    dim, value = F.col("dim"), F.col("value")
    sums = long.groupBy("key").agg(
        total((dim == "sgjp_status") & value.isin(*CAPITAL_STATUS)).alias("status_up"),
        total((dim == "sgjp_status") & value.isin(*LOWER_STATUS)).alias("status_low"),
        total((dim == "classes") & (value == "CW")).alias("common"),
        total((dim == "classes") & value.isin(*PROPER_CLASSES)).alias("proper"),
        total((dim == "classes") & value.isin(*LEXICAL_CLASSES)).alias("lexical"),
        total((dim == "forms") & X.starts_upper(value)).alias("form_up"),
        total((dim == "forms") & X.starts_lower(value)).alias("form_low"),
        total((dim == "lemmas") & X.starts_upper(value)).alias("lemma_up"),
        total((dim == "lemmas") & X.starts_lower(value)).alias("lemma_low"),
    )
    c = F.col
    steps = [
        (c("status_up") > c("status_low"), "capitalized", "sgjp-directional"),
        (c("status_low") > c("status_up"), "lowercase", "sgjp-directional"),
        (c("common") > 0, "lowercase", "common-word"),
        ((c("proper") > 0) & (c("form_up") > c("form_low")), "capitalized", "proper-name-observed"),
        ((c("proper") > 0) & (c("form_low") > c("form_up")), "lowercase", "proper-name-observed"),
        (c("lexical") > 0, "lowercase", "lexical"),
        (c("lemma_up") > c("lemma_low"), "capitalized", "lemma-casing"),
        (c("lemma_low") > c("lemma_up"), "lowercase", "lemma-casing"),
    ]
    policy, basis = F.lit(None).cast("string"), F.lit(None).cast("string")
    for when, p, b in reversed(steps):
        policy, basis = F.when(when, p).otherwise(policy), F.when(when, b).otherwise(basis)
    out = sums.select("key", policy.alias("policy"), basis.alias("basis")).where("policy is not null")
    return out.select("key", X.apply_policy(F.lower("key"), F.col("policy")).alias("surface"), "policy", "basis")


def lemma_verdict(form_lemmas: DataFrame, lemma_verdicts: DataFrame) -> DataFrame:
    """Of a key's lemmas in order of (frequency descending, lemma), the first with a verdict. form_lemmas: key, lemma, n."""
    v = lemma_verdicts.select(F.col("key").alias("lemma"), "policy", "basis")
    best = form_lemmas.join(v, "lemma").groupBy("key").agg(F.min_by(F.struct("policy", "basis"), F.struct((-F.col("n")).alias("n"), "lemma")).alias("v"))
    return best.select("key", X.apply_policy(F.lower("key"), F.col("v.policy")).alias("surface"), F.col("v.policy").alias("policy"), F.concat(F.lit("lemma:"), F.col("v.basis")).alias("basis"))


def analysis_lemma_verdict(analyses: DataFrame, lemma_verdicts: DataFrame) -> DataFrame:
    """Through the analyses' lemmas; capitalized verdicts only, the first lemma in spelling. analyses: orth, lemma."""
    v = lemma_verdicts.where("policy = 'capitalized'").select(F.col("key").alias("lemma_key"), "policy", "basis")
    best = analyses.select(F.lower("orth").alias("key"), F.lower("lemma").alias("lemma_key")).join(v, "lemma_key").groupBy("key").agg(F.min_by(F.struct("policy", "basis"), "lemma_key").alias("v"))
    return best.select("key", X.upper_first(F.col("key")).alias("surface"), F.col("v.policy").alias("policy"), F.concat(F.lit("analysis:"), F.col("v.basis")).alias("basis"))


def verdict_chain(keys: DataFrame, *verdicts: DataFrame) -> DataFrame:
    """The first verdict of the given tables, in order (J8, J7, R7 on the surface, R7 on the lemma)."""
    out = keys.select("key").distinct()
    names = []
    for i, v in enumerate(verdicts):
        out = out.join(v.select("key", F.struct("surface", "policy", "basis").alias(f"v{i}")), "key", "left")
        names.append(f"v{i}")
    return out.select("key", F.coalesce(*names).alias("v")).where("v is not null").select("key", "v.surface", "v.policy", "v.basis")


def component_evidence(sources: DataFrame) -> DataFrame:
    """A row for each component of a source phrase, with its place and policy. sources: surface, policy, source."""
    parts = sources.select("source", F.col("surface").alias("phrase"), F.col("policy").alias("phrase_policy"), F.posexplode(X.dictionary_surfaces(F.col("surface"))).alias("i", "component"))
    return parts.select(F.lower("component").alias("key"), "component", "phrase", (F.col("i") + 1).alias("component_index"), "source", X.component_policy(F.col("component"), F.col("phrase_policy")).alias("policy"))


def analysis_flags(keys: DataFrame, analyses: DataFrame) -> DataFrame:
    """Per key, what its analyses say over both case probes. analyses: orth, lemma, tag, classes.

    Hyphenated keys aren't analysed.
    """
    probes = keys.select("key").distinct().where(~X.is_hyphenated(F.col("key"))).select("key", F.explode(X.surface_variants(F.col("key"))).alias("orth"))
    rows = probes.join(analyses, "orth").dropDuplicates(["key", "orth", "lemma", "tag", "classes"])
    tag, classes = F.col("tag"), F.coalesce("classes", F.array().cast("array<string>"))
    names, pos = F.array_remove(classes, COMMON_CLASS), X.tag_pos(tag)
    ordinary, adjective, sg_nom = pos.isin(*ORDINARY_POS), pos == "adj", X.is_sg_nom_noun(tag)
    is_common, named = F.array_contains(classes, COMMON_CLASS), F.size(names) > 0
    proper = ordinary & named & (~adjective | F.array_contains(names, SURNAME))
    any_ = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    return rows.groupBy("key").agg(
        any_(ordinary & is_common).alias("common_noun"), any_(adjective).alias("adjective"), any_(proper).alias("proper_name"), any_(~pos.isin("ign", "interp") & ~named).alias("lexical"),
        any_(is_common & sg_nom).alias("common_nominative"), any_(named & ~is_common & sg_nom).alias("proper_nominative"), any_(proper & F.exists(names, lambda c: c != SURNAME)).alias("proper_other_than_surname"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.when(proper, names))))).alias("proper_classes"),
    )


def resolve(keys: DataFrame, flags: DataFrame, secondary: DataFrame | None = None, explicit: DataFrame | None = None, official: DataFrame | None = None, module: DataFrame | None = None) -> DataFrame:
    """Key, resolved, surface, policy, reason, basis. The first rule that applies decides.

    flags as of R5. secondary, explicit: key, surface, policy. official, module: key, surface, policy, several rows a key.
    """
    out = keys.select("key").distinct().join(flags, "key", "left")
    one = lambda df, name: out.select("key").withColumn(name, F.lit(None).cast("struct<surface:string,policy:string>")) if df is None else df.select("key", F.struct("surface", "policy").alias(name)).dropDuplicates(["key"])
    many = lambda df, name: out.select("key").withColumn(name, F.lit(None).cast("struct<policies:array<string>,surfaces:array<string>>")) if df is None else df.groupBy("key").agg(F.struct(F.sort_array(F.collect_set("policy")).alias("policies"), F.sort_array(F.collect_set("surface")).alias("surfaces")).alias(name))
    for df, name, kind in ((secondary, "s", one), (explicit, "e", one), (official, "o", many), (module, "m", many)):
        out = out.join(kind(df, name), "key", "left")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    only = lambda c, p: (F.size(f"{c}.policies") == 1) & (F.col(f"{c}.policies")[0] == p)
    key = F.lower("key")
    up = X.upper_first(key)
    single = F.when(F.size("o.surfaces") == 1, F.col("o.surfaces")[0])
    verdict = lambda ok, surface, policy, reason, basis: F.struct(F.lit(ok).alias("resolved"), surface.alias("surface"), (policy if isinstance(policy, Column) else F.lit(policy)).alias("policy"), F.lit(reason).alias("reason"), F.lit(basis).alias("basis"))
    none, no = F.lit(None).cast("string"), F.lit(None).cast("string")
    steps = [
        (flag("common_noun"), verdict(True, key, "lowercase", "common-noun", "analysis")),
        (flag("adjective"), verdict(True, key, "lowercase", "adjective", "analysis")),
        (flag("proper_name"), verdict(True, up, "capitalized", "proper-name", "analysis")),
        (flag("lexical") & (F.col("s.policy") == "capitalized"), verdict(True, up, "capitalized", "secondary-capitalized", "corpus")),
        (flag("lexical"), verdict(True, key, "lowercase", "lexical", "analysis")),
        (F.col("e.policy").isNotNull(), verdict(True, F.col("e.surface"), F.col("e.policy"), "explicit-policy", "policy")),
        (only("o", "lowercase"), verdict(True, F.coalesce(single, key), "lowercase", "official-source", "official")),
        (only("o", "capitalized") & (F.size("o.surfaces") > 1), verdict(False, none, no, "official-surface-conflict", "official")),
        (only("o", "capitalized"), verdict(True, F.coalesce(single, up), "capitalized", "official-source", "official")),
        (F.size("o.policies") > 1, verdict(False, none, no, "official-policy-conflict", "official")),
        (only("m", "lowercase"), verdict(True, key, "lowercase", "module-policy", "module")),
        (only("m", "capitalized"), verdict(True, up, "capitalized", "module-policy", "module")),
        (F.size("m.policies") > 1, verdict(False, none, no, "module-policy-conflict", "module")),
    ]
    best = verdict(False, none, no, "no-evidence", "none")
    for when, v in reversed(steps):
        best = F.when(F.coalesce(when, F.lit(False)), v).otherwise(best)
    return out.select("key", best.alias("v")).select("key", "v.*")


def neutral_lowercase(resolved: DataFrame) -> DataFrame:
    """Unresolved keys in lower case, flagged."""
    miss = ~F.col("resolved")
    return resolved.withColumn("fallback", miss).withColumn("surface", F.when(miss, F.lower("key")).otherwise(F.col("surface"))).withColumn("policy", F.when(miss, "lowercase").otherwise(F.col("policy")))


def dual_casing(flags: DataFrame) -> DataFrame:
    """Keys that are a nominative singular both as common noun and as proper name."""
    return flags.where("common_nominative and proper_nominative").select("key", "proper_classes")


def class_distribution(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts by class, and by exact combination with its kind."""
    each = candidates.select(F.explode("proper_classes").alias("class")).groupBy("class").agg(F.count("*").alias("n"))
    surname, size = F.array_contains("proper_classes", "nazwisko"), F.size("proper_classes")
    kind = F.when(surname & (size == 1), "surname-only").when(surname, "mixed").otherwise("non-surname")
    return each, candidates.groupBy(F.array_join("proper_classes", " + ").alias("combination"), kind.alias("kind")).agg(F.count("*").alias("n"))


def homonym_audit(selected: DataFrame, analyses: DataFrame) -> DataFrame:
    """Selected names whose lower-case spelling also is a common noun. selected: name."""
    common = F.array_contains(F.coalesce("classes", F.array().cast("array<string>")), COMMON_CLASS)
    nouns = analyses.where((X.tag_pos(F.col("tag")) == "subst") & common & (F.col("orth") == F.lower("orth"))).select(F.col("orth").alias("key")).distinct()
    return selected.withColumn("key", F.lower("name")).join(nouns, "key", "left_semi")


def verification(evidence: DataFrame) -> DataFrame:
    """Policies of a key's sources and whether they disagree."""
    return evidence.groupBy("key").agg(F.sort_array(F.collect_set("policy")).alias("source_policies"), F.sort_array(F.collect_set("source")).alias("sources")).withColumn("disagreement", F.size("source_policies") > 1)


def observed_casing(docs: DataFrame, text: str = "text", by: list[str] = ("lang",)) -> DataFrame:
    """For each lower key its upper-first and lower-first uses, with those at a sentence's start apart."""
    found = F.regexp_extract_all(F.col(text), F.lit(r"((?:^|[.!?:]\s+|\n\s*)?\p{L}+)"), 1)
    rows = docs.select(*by, F.explode(found).alias("raw")).withColumn("w", F.regexp_extract("raw", r"(\p{L}+)$", 1))
    rows = rows.withColumn("start", F.col("raw") != F.col("w")).withColumn("up", X.starts_upper(F.col("w")))
    return rows.groupBy(*by, F.lower("w").alias("key")).agg(F.count_if("up").alias("upper"), F.count_if(X.starts_lower(F.col("w"))).alias("lower"), F.count_if(F.col("up") & F.col("start")).alias("upper_at_start"))


def observed_verdict(casing: DataFrame) -> DataFrame:
    """R7's case majority over R15: strict majorities only; sentence starts don't count as upper."""
    up = F.col("upper") - F.col("upper_at_start")
    return casing.withColumn("policy", F.when(up > F.col("lower"), "capitalized").when(F.col("lower") > up, "lowercase")).where("policy is not null")


def related_forms(words: DataFrame, cfg: LexiconConfig, lemmas: DataFrame | None = None) -> DataFrame:
    """Groups of related forms: same fold, or same lemma and part of speech. words: word. lemmas: word, lemma, pos."""
    folds = words.select(F.concat(F.lit("fold:"), X.fold(F.col("word"), cfg)).alias("group"), "word")
    if lemmas is not None:
        folds = folds.unionByName(lemmas.select(F.concat_ws(":", F.lit("lemma"), "lemma", "pos").alias("group"), "word"))
    return folds.distinct().groupBy("group").agg(F.sort_array(F.collect_set("word")).alias("forms")).where(F.size("forms") > 1)


_WHOLE = {"tinyint", "smallint", "int"}
_NULL = (-(2**63) - 1, -(2**31) - 1)


def _place(rows: DataFrame, order: list[str]) -> tuple[Column, dict[str, Column]]:
    """An order of a whole number and maybe an int as one decimal (nulls first), and how to read its columns back from ``place``."""
    kinds = dict(rows.dtypes)
    dec = lambda x: F.lit(str(x)).cast("decimal(20,0)")
    whole = lambda c, none: F.coalesce(F.col(c).cast("decimal(20,0)"), dec(none))
    back = lambda c, x, none: F.when(x != dec(none), x.cast(kinds[c])).alias(c)
    if len(order) == 1:
        return whole(order[0], _NULL[0]), {order[0]: back(order[0], F.col("place"), _NULL[0])}
    base = F.lit(2**33).cast("decimal(11,0)")
    low = F.pmod("place", base)
    high = ((F.col("place") - low) / base).cast("decimal(20,0)")
    packed = (whole(order[0], _NULL[0]) * base + whole(order[1], _NULL[1]) + F.lit(2**32).cast("decimal(11,0)")).cast("decimal(32,0)")
    return packed, {order[0]: back(order[0], high, _NULL[0]), order[1]: back(order[1], (low - F.lit(2**32)).cast("decimal(20,0)"), _NULL[1])}


def keep_first(rows: DataFrame, key: str, order: list[str], value: str) -> tuple[DataFrame, DataFrame]:
    """The first row of each lower key by an explicit order; and (key, value, rows, kept) of keys whose value differs.

    Both come from one aggregate by key and value, so a key's rows are never brought together: first the best row of each value, then the best of those.
    Rows of an order of whole numbers and the value alone are ranked by one number, which a hash aggregate can hold; a struct makes Spark sort all rows.
    """
    kinds = dict(rows.dtypes)
    lean = set(rows.columns) == {*order, value} and value not in order and kinds[order[0]] in {*_WHOLE, "bigint"} and (len(order) == 1 or len(order) == 2 and kinds[order[1]] in _WHOLE)
    if lean and key == value:
        place, back = _place(rows, order)
        found = rows.groupBy(F.col(value).alias("value")).agg(F.min(place).alias("place"), F.count("*").alias("rows"))
        whole = F.struct(*(back.get(c, F.col("value").alias(c)) for c in rows.columns))
        each = found.select(F.lower("value").alias("key"), "value", F.struct("place", "value", whole.alias("row")).alias("first"), "rows")
    else:
        each = rows.groupBy(F.lower(key).alias("key"), F.col(value).alias("value")).agg(F.min(F.struct(F.struct(*order).alias("o"), F.struct(*rows.columns).alias("row"))).alias("first"), F.count("*").alias("rows"))
    each = settled(each, "first-rows")  # else the rows are read and ranked once for the best and once for the conflicts
    per = each.groupBy("key").agg(F.min("first").alias("first"), F.count("*").alias("n_values"))
    bad = each.withColumnRenamed("first", "own").join(per.where("n_values > 1"), "key").select("key", "value", "rows", (F.col("own") == F.col("first")).alias("kept"))
    return per.select("first.row.*", "key") if "key" not in rows.columns else per.select("first.row.*"), bad
