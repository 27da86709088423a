"""Selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.config import CASES, LexiconConfig
from wordloom.functions import text as X
from wordloom.sources.writers import settled

CORRECT = ("CORR", "TAGD", "PLTAN", "TAGE", "DIAL")
# Weight of a case when one form has to stand for all.
CASE_PRIORITY = {"gen": 7, "loc": 6, "inst": 5, "acc": 4, "dat": 3, "voc": 2, "nom": 1}


def gate_candidates(words: DataFrame, cfg: LexiconConfig, column: str = "word") -> tuple[DataFrame, DataFrame]:
    """Candidates, and one row with accepted and rejected counts."""
    ok = X.is_candidate(F.col(column), cfg)
    return words.where(ok), words.agg(F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("rejected"))


def correct_rows(tagged: DataFrame) -> DataFrame:
    """P2"""
    full = (F.col("form") != "") & (F.col("lemma") != "") & (F.col("classification") != "")
    return tagged.where(F.col("correctness").isin(*CORRECT) & (F.col("frequency") > 0) & full)


def foreign_dominant(zipfs: DataFrame, cfg: LexiconConfig, cap: bool = True) -> DataFrame:
    """Word, own zipf, best rival. zipfs: lang, word, zipf. Of equal rivals the first in the configured order wins."""
    order = F.array_position(F.array(*map(F.lit, cfg.rivals)), F.col("lang"))
    own = F.max(F.when(F.col("lang") == cfg.language, F.col("zipf")))
    rival = F.when(F.col("lang").isin(*cfg.rivals), F.struct("zipf", (-order).alias("turn"), "lang"))
    best = zipfs.groupBy("word").agg(F.coalesce(own, F.lit(0.0)).alias("zipf_own"), F.max(rival).alias("r"))
    lead = F.col("r.zipf") > F.round(F.col("zipf_own") + cfg.rival_lead, 6)
    rule = (F.col("r.zipf") >= cfg.rival_floor) & lead
    if cap:
        rule = rule & (F.col("zipf_own") < cfg.own_cap)
    return best.where(rule).select("word", "zipf_own", F.col("r.lang").alias("rival"), F.col("r.zipf").alias("zipf_rival"))


def exclude(words: DataFrame, blocked: DataFrame, on: str = "word") -> DataFrame:
    """P4 as an exclusion; ``with_evidence`` keeps the reason instead."""
    return words.join(blocked, on, "left_anti")


def registry_filter(rows: DataFrame, column: str = "rm", value: str = "96") -> DataFrame:
    """P8"""
    return rows.where(F.col(column) == value)


def single_token(rows: DataFrame, column: str = "name") -> DataFrame:
    """``eligible_single_token``: whether the name is one run of letters; every row stays."""
    return rows.withColumn("eligible_single_token", F.coalesce(F.col(column).rlike(r"^\p{L}+$"), F.lit(False)))


def split_rejected(rows: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """P10: accepted and rejected rows."""
    flag = F.coalesce(ok, F.lit(False))
    return rows.where(flag), rows.where(~flag)


def with_evidence(words: DataFrame, sets: dict[str, DataFrame], on: str = "word") -> DataFrame:
    """A boolean column for each evidence set."""
    for name, s in sets.items():
        words = words.join(s.select(on).distinct().withColumn(name, F.lit(True)), on, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return words


def attach_evidence(words: DataFrame, sets: dict[str, DataFrame], values: dict[str, DataFrame], on: str = "word") -> DataFrame:
    """J1, J2 for words that occur once each: a boolean column for each evidence set and the value each table of ``values`` gives (of several the largest).

    All tables become one union of tagged rows and meet the words in one shuffle; sets needn't be distinct, as flags are or-ed before it.
    """
    parts = [words.select(on, F.struct(*(c for c in words.columns if c != on)).alias("own"))]
    parts += [s.select(on, F.lit(True).alias(name)) for name, s in sets.items()] + [v.select(on, F.col(name).alias(name)) for name, v in values.items()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    found = rows.groupBy(on).agg(F.max("own").alias("own"), *(F.coalesce(F.bool_or(n), F.lit(False)).alias(n) for n in sets), *(F.max(n).alias(n) for n in values)).where("own is not null")
    return found.select(on, "own.*", *sets, *values)


def override(rows: DataFrame, policy: DataFrame, key: str = "key") -> DataFrame:
    """An override's surface and policy replace a row's."""
    o = policy.select(key, F.col("surface").alias("o_surface"), F.col("policy").alias("o_policy"))
    return rows.join(o, key, "left").withColumn("surface", F.coalesce("o_surface", "surface")).withColumn("policy", F.coalesce("o_policy", "policy")).drop("o_surface", "o_policy")


def typo_pairs(words: DataFrame, targets: DataFrame, indels: bool = False) -> DataFrame:
    """(word, target, kind) one edit apart, through shared single-delete keys.

    Both tables have a column word; others come along as ``word_*`` and ``target_*``. Without ``indels`` only words of equal length meet.
    """
    def keyed(df: DataFrame, name: str) -> DataFrame:
        keys = X.single_deletes(F.col("word"))
        if indels:
            keys = F.array_distinct(F.concat(keys, F.array("word")))
        more = [F.col(c).alias(f"{name}_{c}") for c in df.columns if c != "word"]
        # Words of one length share keys only with each other; short ones, of whom very many share a key, also fill fewer groups so.
        return df.withColumn("k", F.explode(keys)).select(F.col("word").alias(name), "k", F.lit(0).alias("n") if indels else F.length("word").alias("n"), *more)

    met = keyed(words, "word").join(keyed(targets, "target"), ["n", "k"]).where("word <> target").drop("n", "k").distinct()
    return met.withColumn("kind", X.edit1_kind(F.col("word"), F.col("target"))).where("kind is not null")


def typo_targets(zipfs: DataFrame, known: DataFrame, cfg: LexiconConfig, indels: bool = False) -> DataFrame:
    """J4 + W7: for each rare unknown word its best target: the largest gap, then the smaller spelling.

    zipfs: word, zipf. known: word (well-evidenced words, the possible targets).
    """
    good = known.select("word").distinct()
    suspects = zipfs.join(good, "word", "left_anti").where((F.length("word") >= 3) & (F.col("zipf") < cfg.own_cap))
    targets = zipfs.join(good, "word", "left_semi").where(F.length("word") >= (2 if indels else 3))
    pairs = typo_pairs(suspects.select("word", "zipf"), targets.select("word", "zipf"), indels)
    pairs = pairs.withColumn("gap", F.round(F.col("target_zipf") - F.col("word_zipf"), 6))
    least = F.lit(None).cast("double")
    for length, gap in reversed(cfg.typo_gaps):
        least = F.when(F.length("word") <= length, F.lit(gap)).otherwise(least)
    w = Window.partitionBy("word").orderBy(F.desc("gap"), "target")
    best = pairs.where((F.col("gap") > 0) & (F.col("gap") >= least)).withColumn("k", F.row_number().over(w)).where("k = 1")
    return best.select("word", "target", "kind", "gap")


#: First match wins. Kept by the sources in this order, after the three lists that drop and the guards.
DROP_LISTS = (("blocked", "reviewed-typo-blocklist"), ("regression", "swipe-regression-blocklist"), ("excluded", "source-excluded-first-name"))
KEEP_LISTS = (
    ("guard", "guard"), ("terc", "reviewed-terc-source"), ("terc_inflection", "reviewed-terc-inflection"), ("country_inflection", "reviewed-country-inflection"), ("country", "reviewed-country"),
    ("capital_inflection", "reviewed-capital-inflection"), ("capital", "reviewed-capital"), ("custom", "custom-manual"), ("first_name_inflection", "reviewed-first-name-inflection"),
    ("city_inflection", "reviewed-city-inflection"), ("city", "reviewed-city"), ("historical_name", "reviewed-historical-first-name"), ("first_name", "reviewed-first-name"),
)


def cascade(rows: DataFrame) -> DataFrame:
    """C1 (with P4-P6): decision and reason of each word, by one CASE chain.

    rows: word, spell, keyboard, rival (NULL: not foreign), typo_target (NULL: none) and any of the list flags;
    a missing flag counts as false.
    """
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)) if c in rows.columns else F.lit(False)
    steps = [(flag(c), F.lit("drop"), F.lit(r)) for c, r in DROP_LISTS] + [(flag(c), F.lit("keep"), F.lit(r)) for c, r in KEEP_LISTS]
    spell, keyboard = flag("spell"), flag("keyboard")
    steps += [
        (F.col("rival").isNotNull(), F.lit("drop"), F.concat(F.lit("foreign:"), F.col("rival"))),
        (X.is_ascii(F.col("word")) & ~(spell & keyboard), F.lit("drop"), F.lit("ascii-without-dual-evidence")),
        (~(spell | keyboard) & F.col("typo_target").isNotNull(), F.lit("drop"), F.concat(F.lit("typo->"), F.col("typo_target"))),
        (~(spell | keyboard), F.lit("drop"), F.lit("no-positive-evidence")),
    ]
    decision, reason = F.lit("keep"), F.lit("spell-evidence")
    for when, d, r in reversed(steps):
        decision, reason = F.when(when, d).otherwise(decision), F.when(when, r).otherwise(reason)
    return rows.withColumn("decision", decision).withColumn("reason", reason)


#: Lists whose words an accented form doesn't displace.
ALIAS_EXEMPT = ("guard", "terc_inflection", "country", "country_inflection", "capital", "capital_inflection", "custom", "first_name_inflection", "city_inflection")


def suppress_aliases(rows: DataFrame, cfg: LexiconConfig) -> DataFrame:
    """Drop a kept bare word if its fold group has an accented kept word with positive evidence.

    rows: as ``cascade`` returns them, with zipf. The target is the accented word with the highest zipf, then the first in spelling.
    """
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)) if c in rows.columns else F.lit(False)
    kept, marked = F.col("decision") == "keep", X.has_mark(F.col("word"), cfg)
    positive = flag("spell") | flag("keyboard")
    exempt = positive
    for c in ALIAS_EXEMPT:
        exempt = exempt | flag(c)
    groups = rows.where(kept & marked).withColumn("fold", X.fold(F.col("word"), cfg))
    w = Window.partitionBy("fold").orderBy(F.desc("zipf"), "word")
    best = groups.withColumn("k", F.row_number().over(w)).where("k = 1").select("fold", F.col("word").alias("accented"), positive.alias("accented_positive"))
    hit = kept & ~marked & ~exempt & F.col("accented").isNotNull() & F.col("accented_positive")
    out = rows.withColumn("fold", X.fold(F.col("word"), cfg)).join(best, "fold", "left")
    out = out.withColumn("reason", F.when(hit, F.concat(F.lit("diacritic-alias->"), F.col("accented"))).otherwise(F.col("reason"))).withColumn("decision", F.when(hit, "drop").otherwise(F.col("decision")))
    return out.drop("fold", "accented", "accented_positive")


def capacity_cut(rows: DataFrame, limit: int, protected: Column, overfull: bool = False) -> DataFrame:
    """Protected words stay; the rest fill what is left by (rank, -zipf, word). Aborts if the protected don't fit; if ``overfull``, they stay alone instead.

    The cut is one ordered limit (a top-k in each task) and one join; no global window.
    """
    shield = F.coalesce(protected, F.lit(False))
    kept = rows.where("decision = 'keep'")
    n = kept.agg(F.count_if(shield).alias("p"), F.count("*").alias("n")).first()
    if n["n"] <= limit:
        return rows
    if n["p"] > limit and not overfull:
        raise ValueError(f"{n['p']} protected words exceed the limit of {limit}")
    fit = kept.where(~shield).orderBy("rank", F.desc("zipf"), "word").limit(max(limit - n["p"], 0)).select("word", F.lit(True).alias("fits"))
    cut = (F.col("decision") == "keep") & ~shield & F.col("fits").isNull()
    out = rows.join(fit, "word", "left")
    return out.withColumn("reason", F.when(cut, "limit-cut").otherwise(F.col("reason"))).withColumn("decision", F.when(cut, "drop").otherwise(F.col("decision"))).drop("fits")


def displaced(rows: DataFrame, limit: int, added: Column, protected: Column, guards: Column) -> DataFrame:
    """Words that the cut keeps without the added ones and drops with them. Protected words beyond the limit displace all others: an audit has to show that, not to stop."""
    full = capacity_cut(rows, limit, protected, overfull=True).where("decision = 'keep'").select("word")
    bare = capacity_cut(rows.where(~F.coalesce(added, F.lit(False))), limit, guards, overfull=True).where("decision = 'keep'").select("word")
    return bare.join(full, "word", "left_anti")


def candidate_ranks(base: DataFrame, layers: list[DataFrame], top: int | None = None) -> DataFrame:
    """Rank, word, layer. base: word, cnt (ranked by count); each further layer follows in spelling order, without words met before.

    The order is global: rows are sorted by range and numbered by partition offsets, not in one window.
    """
    first = base.groupBy(F.lower("word").alias("word")).agg(F.max("cnt").alias("cnt"))
    if top is not None:
        first = first.orderBy(F.desc("cnt"), "word").limit(top)
    rows = first.withColumn("layer", F.lit(0))
    for i, layer in enumerate(layers, 1):
        new = layer.select(F.lower("word").alias("word")).distinct()
        rows = rows.unionByName(new.select("word", F.lit(0).cast("long").alias("cnt"), F.lit(i).alias("layer")))
    rows = rows.groupBy("word").agg(F.min(F.struct("layer", (-F.col("cnt")).alias("c"))).alias("k")).select("word", F.col("k.layer").alias("layer"), (-F.col("k.c")).alias("cnt"))
    return number_rows(rows, ["layer", F.desc("cnt"), "word"], "rank")


def number_rows(rows: DataFrame, order: list, name: str) -> DataFrame:
    """Global numbers from 0: a range sort, a count for each partition, and offsets from their prefix sum."""
    part = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id())
    part = settled(part, "numbered")  # sizes and rows must come from one run of the range sort
    sizes = part.groupBy("__p").agg(F.count("*").alias("__n"), F.min("__i").alias("__first"))  # one row for each partition
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__p", "__first", before.alias("__start"))
    return part.join(F.broadcast(starts), "__p").withColumn(name, F.col("__i") - F.col("__first") + F.col("__start")).drop("__p", "__i", "__n", "__first", "__start")


def retain_by_level(forms: DataFrame, counts: DataFrame, zipfs: DataFrame) -> DataFrame:
    """Every form with its retention. forms: level, code, name, case, form. counts: word, cnt. zipfs: word, zipf.

    Voivodeships keep all; communes the nominative; counties what the corpus has, or else the one form with
    the highest (zipf, case weight, case order, spelling).
    """
    weight = F.create_map(*(F.lit(x) for kv in CASE_PRIORITY.items() for x in kv))
    turn = F.array_position(F.array(*map(F.lit, CASES)), F.col("case"))
    rows = forms.withColumn("word", F.lower("form")).join(counts.select("word", "cnt"), "word", "left").join(zipfs.select("word", "zipf"), "word", "left")
    nominative = F.col("case") == "nom"
    seen = ~nominative & (F.coalesce("cnt", F.lit(0)) > 0)
    group = Window.partitionBy("level", "code", "name")
    rows = rows.withColumn("any_seen", F.max(seen).over(group))
    score = F.struct(F.coalesce("zipf", F.lit(0.0)).alias("z"), weight[F.col("case")].alias("w"), (-turn).alias("t"), F.col("form").alias("f"))
    rows = rows.withColumn("best", F.max(F.when(~nominative, score)).over(group))
    mode = (
        F.when(F.col("level") == "voivodeship", "full")
        .when(F.col("level") == "gmina", "nominative-only")
        .when(F.col("any_seen"), "nkjp-observed")
        .when(F.col("best").isNotNull(), "weighted-fallback")
        .otherwise("nominative-only-no-non-nom")
    )
    keep = nominative | (F.col("level") == "voivodeship") | ((F.col("level") == "powiat") & F.when(F.col("any_seen"), seen).otherwise((F.col("best.f") == F.col("form")) & (F.col("best.t") == -turn)))
    dropped = F.when(F.col("level") == "gmina", "excluded-gmina-nominative-only").otherwise("excluded-powiat-frequency-not-observed")
    return rows.select("level", "code", "name", "case", "form", F.coalesce(keep, F.lit(False)).alias("kept"), F.when(keep, mode).otherwise(dropped).alias("retention"))


def audit_status(rows: DataFrame, cfg: LexiconConfig) -> DataFrame:
    """C5, A20. rows: word, regression, excluded, in_preview, zipf_own, zipf_rival."""
    foreign = (F.col("zipf_rival") >= cfg.rival_floor) & (F.col("zipf_rival") > F.col("zipf_own") + cfg.rival_lead)
    status = (
        F.when(F.col("regression"), "BLOCKED_REGRESSION")
        .when(F.col("excluded"), "SOURCE_EXCLUDED")
        .when(~F.col("in_preview"), "NOT_IN_PREVIEW")
        .when(foreign, "IN_PREVIEW_FOREIGN_SIGNAL")
        .when(F.col("zipf_own") >= cfg.common_zipf, "IN_PREVIEW_COMMON_WORD_SIGNAL")
        .otherwise("IN_PREVIEW_CLEAN_SIGNAL")
    )
    return rows.withColumn("audit_status", status)


def reason_counts(decisions: DataFrame) -> DataFrame:
    """A8"""
    return decisions.groupBy("decision", X.reason_class(F.col("reason")).alias("reason_class")).agg(F.count("*").alias("n"))


def top_sample(rows: DataFrame, by: str, k: int = 100, key: str = "word") -> DataFrame:
    """W11"""
    return rows.orderBy(F.desc(by), key).limit(k)
