"""Casing decisions as one fold over all evidence of a key (R5-R9, J7, J8), and the lattice of name classes.

Every source of evidence becomes rows of one tagged union; a row fills its own columns and leaves the others null. One shuffle on the key brings them
together, and every aggregate is a sum, a flag or a minimum, so each task adds up its rows first and no key's rows are ever gathered. The ordered rules then
read the finished columns. Only evidence that reaches a key over a lemma takes a join before: see ``lemma_links``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions import text as X
from wordloom.operators.casing import CAPITAL_STATUS, COMMON_CLASS, LEXICAL_CLASSES, LOWER_STATUS, ORDINARY_POS, PROPER_CLASSES, SURNAME
from wordloom.sources.writers import settled

#: A lemma with more than this share of all links is dealt to ``SALTS`` tasks; there are at most 1 / HEAVY of them.
HEAVY, SALTS = 1 / 200, 32

_UP, _LOW = "capitalized", "lowercase"


def _sums() -> dict[str, Column]:
    """What a row of the tagged corpus adds to each weight of R7."""
    form, lemma, status, cls = map(F.col, ("form", "lemma", "sgjp_status", "classification"))
    return {
        "status_up": status.isin(*CAPITAL_STATUS), "status_low": status.isin(*LOWER_STATUS),
        "common": cls == "CW", "proper": cls.isin(*PROPER_CLASSES), "lexical": cls.isin(*LEXICAL_CLASSES),
        "form_up": X.starts_upper(form), "form_low": X.starts_lower(form), "lemma_up": X.starts_upper(lemma), "lemma_low": X.starts_lower(lemma),
    }


WEIGHTS = ("status_up", "status_low", "common", "proper", "lexical", "form_up", "form_low", "lemma_up", "lemma_low")


def weighed(tagged: DataFrame) -> DataFrame:
    """``tagged`` with its frequency under each weight it speaks for."""
    return tagged.select("*", *(F.when(c, F.col("frequency")).alias(f"w_{n}") for n, c in _sums().items()))


def _summed(prefix: str = "") -> list[Column]:
    return [F.coalesce(F.sum(f"w_{n}"), F.lit(0)).alias(f"{prefix}{n}") for n in WEIGHTS]


def ordered(steps: list[tuple[Column, Column]], otherwise: Column) -> Column:
    """The value of the first step that holds; a null condition doesn't."""
    return reduce(lambda rest, s: F.when(F.coalesce(s[0], F.lit(False)), s[1]).otherwise(rest), reversed(steps), otherwise)


def verdict(prefix: str = "") -> Column:
    """struct(policy, basis) of finished weights, or null. Equal weights fall through to the next rule."""
    c = lambda n: F.col(f"{prefix}{n}")
    says = lambda policy, basis: F.struct(F.lit(policy).alias("policy"), F.lit(basis).alias("basis"))
    steps = [
        (c("status_up") > c("status_low"), says(_UP, "sgjp-directional")), (c("status_low") > c("status_up"), says(_LOW, "sgjp-directional")),
        (c("common") > 0, says(_LOW, "common-word")),
        ((c("proper") > 0) & (c("form_up") > c("form_low")), says(_UP, "proper-name-observed")), ((c("proper") > 0) & (c("form_low") > c("form_up")), says(_LOW, "proper-name-observed")),
        (c("lexical") > 0, says(_LOW, "lexical")),
        (c("lemma_up") > c("lemma_low"), says(_UP, "lemma-casing")), (c("lemma_low") > c("lemma_up"), says(_LOW, "lemma-casing")),
    ]
    return ordered(steps, F.lit(None).cast("struct<policy:string,basis:string>"))


def lemma_verdicts(tagged: DataFrame) -> DataFrame:
    """R7 by lemma: lemma (lower case), policy, basis, links (rows behind it)."""
    sums = weighed(tagged).groupBy(F.lower("lemma").alias("lemma")).agg(*_summed(), F.count("*").alias("links"))
    return sums.select("lemma", "links", verdict().alias("v")).where("v is not null").select("lemma", "v.policy", "v.basis", "links")


def lemma_links(tagged: DataFrame, analyses: DataFrame, verdicts: DataFrame, heavy: float = HEAVY, salts: int = SALTS) -> DataFrame:
    """Key, lemma, n, hop (``corpus`` or ``analysis``), policy, basis: every lemma of a key that has a verdict.

    A corpus link carries the frequency of one spelling of the lemma with that key; an analysis link comes from analyses of the key itself and counts
    for capitalized verdicts only. Lemmas that very many keys share are dealt to several tasks by the key.
    """
    corpus = tagged.groupBy(F.lower("form").alias("key"), "lemma").agg(F.sum("frequency").alias("n")).select("key", F.lower("lemma").alias("lemma"), "n", F.lit("corpus").alias("hop"))
    own = analyses.where(F.col("orth") == F.lower("orth")).select(F.col("orth").alias("key"), F.lower(F.trim("lemma")).alias("lemma")).where("lemma <> ''").distinct()
    links = corpus.unionByName(own.select("key", "lemma", F.lit(None).cast("long").alias("n"), F.lit("analysis").alias("hop")))
    total = verdicts.agg(F.sum("links")).first()[0] or 0
    # At most 1 / heavy lemmas.
    frequent = F.broadcast(verdicts.where(F.col("links") > heavy * total).select("lemma", F.lit(salts).alias("salts")))
    spread = links.join(frequent, "lemma", "left").withColumn("salt", F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64("key"), "salts")).otherwise(0).cast("int"))
    copies = verdicts.join(frequent, "lemma", "left").select("lemma", "policy", "basis", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
    return spread.join(copies, ["lemma", "salt"]).where((F.col("hop") == "corpus") | (F.col("policy") == _UP)).select("key", "lemma", "n", "hop", "policy", "basis")


def best_link() -> dict[str, Column]:
    """Aggregates over links of one key: by corpus frequency, then lemma; by lemma alone for analyses."""
    v = F.struct("policy", "basis", "lemma", "n")
    corpus = F.col("hop") == "corpus"
    return {
        "j7": F.min_by(v, F.when(corpus, F.struct((-F.col("n")).alias("n"), F.col("lemma").alias("l")))),
        "j8": F.min_by(v, F.when(~corpus, F.struct(F.col("lemma").alias("l")))),
    }


def linked(links: DataFrame) -> DataFrame:
    """J7 and J8 of each key that has them: key, j7_lemma, j7_n, j7_policy, j8_lemma, j8_policy."""
    out = links.groupBy("key").agg(*(c.alias(n) for n, c in best_link().items()))
    return out.select("key", F.col("j7.lemma").alias("j7_lemma"), F.col("j7.n").alias("j7_n"), F.col("j7.policy").alias("j7_policy"), F.col("j8.lemma").alias("j8_lemma"), F.col("j8.policy").alias("j8_policy"))


def analysis_marks(analyses: DataFrame) -> DataFrame:
    """Key and what one analysis says of it. Only the two case probes of a key count, and none of a hyphenated key.

    analyses: orth, lemma, tag, classes (array, may be null).
    """
    key = F.lower("orth")
    probe = ((F.col("orth") == key) | (F.col("orth") == X.upper_first(key))) & ~key.rlike(f"[{X.HYPHENS}]")
    classes = F.filter(F.coalesce("classes", F.array().cast("array<string>")), lambda c: c != "")
    rows = analyses.where(probe).select(key.alias("key"), "lemma", "tag", classes.alias("classes"), F.array_remove(classes, COMMON_CLASS).alias("names"), X.tag_pos(F.col("tag")).alias("pos"))
    ordinary, adjective, named = F.col("pos").isin(*ORDINARY_POS), F.col("pos") == "adj", F.size("names") > 0
    return rows.select(
        "key", "lemma", "tag", "names", "pos",
        (ordinary & F.array_contains("classes", COMMON_CLASS)).alias("is_common"), adjective.alias("is_adjective"),
        (ordinary & named & (~adjective | F.array_contains("names", SURNAME))).alias("is_name"), (~F.col("pos").isin("ign", "interp") & ~named).alias("is_lexical"),
    )


def evidence(keys: DataFrame, tagged: DataFrame, analyses: DataFrame, explicit: DataFrame | None = None, official: DataFrame | None = None, module: DataFrame | None = None) -> DataFrame:
    """All evidence as one table of rows with a ``key``; see the columns that ``resolve`` folds.

    keys: key. tagged: form, lemma, frequency, sgjp_status, classification. explicit, official, module: key, surface, policy.
    """
    verdicts = settled(lemma_verdicts(tagged), "lemma-verdicts")
    known = F.col("policy").isin(_UP, _LOW)
    spelled = F.when(F.lower(F.trim("surface")) == F.col("key"), F.trim("surface"))
    parts = [
        keys.select(F.lower("key").alias("key"), F.lit(True).alias("asked")),
        weighed(tagged).select(F.lower("form").alias("key"), *(f"w_{n}" for n in WEIGHTS)),
        verdicts.select(F.col("lemma").alias("key"), F.struct("policy", "basis").alias("own")),
        lemma_links(tagged, analyses, verdicts),
        analysis_marks(analyses).select("key", "is_common", "is_adjective", "is_name", "is_lexical"),
    ]
    if explicit is not None:
        parts.append(explicit.select(F.lower("key").alias("key"), F.struct("surface", "policy").alias("told")))
    if official is not None:
        parts.append(official.where(known).select(F.lower("key").alias("key"), "surface", "policy").select("key", F.col("policy").alias("official"), spelled.alias("spelled")))
    if module is not None:
        parts.append(module.where(known).select(F.lower("key").alias("key"), F.col("policy").alias("module")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


_OPTIONAL = {"told": "struct<surface:string,policy:string>", "official": "string", "spelled": "string", "module": "string"}


def resolve(rows: DataFrame) -> DataFrame:
    """R6, R8, R9 over ``evidence``: key, resolved, surface, policy, reason, basis, explicit_policy_conflict, secondary_policy, secondary_basis, secondary_lemma.

    A key without a decision stays in lower case with ``resolved`` false. ``explicit_policy_conflict``: a linguistic rule overrules a reviewed policy.
    """
    for name, kind in _OPTIONAL.items():
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    flag = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    folded = rows.groupBy("key").agg(
        flag(F.col("asked")).alias("asked"), *_summed(), *(c.alias(n) for n, c in best_link().items()), F.min("own").alias("own"), F.min("told").alias("told"),
        *(flag(F.col(c)).alias(c) for c in ("is_common", "is_adjective", "is_name", "is_lexical")),
        *(flag(F.col(c) == p).alias(f"{c}_{s}") for c in ("official", "module") for p, s in ((_UP, "up"), (_LOW, "low"))), F.min("spelled").alias("first_spelled"), F.max("spelled").alias("last_spelled"),
    ).where("asked")
    picked = lambda s, basis, lemma: F.when(F.col(s).isNotNull(), F.struct(F.col(f"{s}.policy").alias("policy"), F.concat(F.lit(basis), F.col(f"{s}.basis")).alias("basis"), lemma.alias("lemma")))
    none = F.lit(None).cast("string")
    second = F.coalesce(picked("j8", "analysis:", F.col("j8.lemma")), picked("j7", "lemma:", F.col("j7.lemma")), picked("surface_verdict", "surface:", none), picked("own", "own-lemma:", F.col("key")))
    rows = folded.withColumn("surface_verdict", verdict()).withColumn("second", second)
    key, up, told = F.col("key"), X.upper_first(F.col("key")), F.col("told.policy")
    one = F.when(F.col("first_spelled") == F.col("last_spelled"), F.col("first_spelled"))
    off = lambda s: F.col(f"official_{s}") if s else None

    def says(ok: bool, surface: Column, policy: Column | str, reason: str, basis: str, against: bool = False) -> Column:
        p = F.lit(policy) if isinstance(policy, str) else policy
        conflict = F.coalesce(told != p, F.lit(False)) if against else F.lit(False)
        return F.struct(F.lit(ok).alias("resolved"), surface.alias("surface"), p.alias("policy"), F.lit(reason).alias("reason"), F.lit(basis).alias("basis"), conflict.alias("explicit_policy_conflict"))

    steps = [
        (F.col("is_common"), says(True, key, _LOW, "common-noun", "analysis", True)),
        (F.col("is_adjective"), says(True, key, _LOW, "adjective", "analysis", True)),
        (F.col("is_name"), says(True, up, _UP, "proper-name", "analysis", True)),
        (F.col("is_lexical") & (F.col("second.policy") == _UP), says(True, up, _UP, "secondary-capitalized", "corpus", True)),
        (F.col("is_lexical"), says(True, key, _LOW, "lexical", "analysis", True)),
        (told.isNotNull(), says(True, F.col("told.surface"), told, "explicit-policy", "policy")),
        (off("low") & ~off("up"), says(True, F.coalesce(one, key), _LOW, "official-source", "official")),
        (off("up") & ~off("low") & (F.col("first_spelled") != F.col("last_spelled")), says(False, key, _LOW, "official-surface-conflict", "official")),
        (off("up") & ~off("low"), says(True, F.coalesce(one, up), _UP, "official-source", "official")),
        (off("up") & off("low"), says(False, key, _LOW, "official-policy-conflict", "official")),
        (F.col("module_low") & ~F.col("module_up"), says(True, key, _LOW, "module-policy", "module")),
        (F.col("module_up") & ~F.col("module_low"), says(True, up, _UP, "module-policy", "module")),
        (F.col("module_up") & F.col("module_low"), says(False, key, _LOW, "module-policy-conflict", "module")),
    ]
    best = ordered(steps, says(False, key, _LOW, "no-evidence", "none"))
    return rows.select("key", best.alias("v"), "second").select("key", "v.*", F.col("second.policy").alias("secondary_policy"), F.col("second.basis").alias("secondary_basis"), F.col("second.lemma").alias("secondary_lemma"))


def class_masks(analyses: DataFrame, classes: list[str], common: tuple[str, ...] = (COMMON_CLASS,)) -> DataFrame:
    """Key, is_common, mask: the name classes of a key's singular nominative noun analyses as one bit each; bits are or-ed, nothing is gathered.

    An analysis with a common class is common and names nothing. At most 63 classes.
    """
    if len(classes) > 63:
        raise ValueError("more classes than bits")
    key = F.lower("orth")
    probe = (F.col("orth") == key) | (F.col("orth") == X.upper_first(key))
    names = F.coalesce("classes", F.array().cast("array<string>"))
    is_common = reduce(lambda a, b: a | b, (F.array_contains(names, c) for c in common))
    bits = reduce(lambda a, b: a.bitwiseOR(b), (F.when(F.array_contains(names, c), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, c in enumerate(classes)), F.lit(0).cast("long"))
    rows = analyses.where(probe & X.is_sg_nom_noun(F.col("tag"))).select(key.alias("key"), is_common.alias("c"), F.when(is_common, F.lit(0).cast("long")).otherwise(bits).alias("b"))
    return rows.groupBy("key").agg(F.bool_or("c").alias("is_common"), F.bit_or("b").alias("mask"))


def class_lattice(masks: DataFrame, classes: list[str]) -> DataFrame:
    """A16 over keys that are both common and a name: level, name, kind, n.

    level ``combination``: an exact set of classes; ``class``: one class, over all sets that hold it. One count of masks serves both.
    """
    sets = masks.where("is_common and mask <> 0").groupBy("mask").agg(F.count("*").alias("n"))
    held = F.filter(F.array(*(F.when(F.col("mask").bitwiseAND(F.lit(1 << i)) != 0, F.lit(c)) for i, c in enumerate(classes))), lambda c: c.isNotNull())
    sets = sets.select("n", F.sort_array(held).alias("names"))
    kind = F.when(F.array_contains("names", SURNAME) & (F.size("names") == 1), "surname-only").when(F.array_contains("names", SURNAME), "mixed").otherwise("non-surname")
    combos = sets.select(F.lit("combination").alias("level"), F.array_join("names", " + ").alias("name"), kind.alias("kind"), "n")
    each = sets.select(F.explode("names").alias("name"), "n").groupBy("name").agg(F.sum("n").alias("n"))
    return combos.unionByName(each.select(F.lit("class").alias("level"), "name", F.lit(None).cast("string").alias("kind"), "n"))


def class_list(analyses: DataFrame, common: tuple[str, ...] = (COMMON_CLASS,), most: int = 63) -> list[str]:
    """The name classes that occur, in order; a tag set, so a bounded one: raises beyond ``most``."""
    found = analyses.select(F.explode("classes").alias("c")).where((F.col("c") != "") & ~F.col("c").isin(*common)).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} name classes")
    return sorted(r["c"] for r in found)
