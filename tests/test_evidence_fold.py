"""The casing fold and the class lattice, rule by rule and against plain Python."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wordloom.operators import evidence_fold as E

TAGGED = "form string, lemma string, tag string, frequency long, morphology string, sgjp_status string, classification string, correctness string"
ANALYSES = "orth string, lemma string, tag string, classes array<string>"
POLICY = "key string, surface string, policy string"


def tagged(spark, rows):
    return spark.createDataFrame([(f, l, "t", n, "m", s, c, "CORR") for f, l, n, s, c in rows], TAGGED)


def fold(spark, keys, corpus=(), analyses=(), explicit=(), official=(), module=()):
    tables = [spark.createDataFrame(list(x), s) for x, s in (([(k,) for k in keys], "key string"), (analyses, ANALYSES), (explicit, POLICY), (official, POLICY), (module, POLICY))]
    rows = E.evidence(tables[0], tagged(spark, corpus), *tables[1:])
    return {r["key"]: r for r in E.resolve(rows).collect()}


def test_every_rule_in_order(spark):
    an = [
        ("dom", "dom", "subst:sg:nom:m3", ["nazwa_pospolita"]), ("Dom", "Dom", "subst:sg:nom:m1", ["nazwisko"]), ("nowy", "nowy", "adj:sg:nom:m:pos", ["geograficzna"]), ("Anna", "Anna", "subst:sg:nom:f", ["imię"]), ("iść", "iść", "inf:imperf", []),
        ("ala", "ala", "adv", None), ("xx", "xx", "ign", []), ("a-b", "a-b", "adj:sg:nom:m:pos", []), ("DOM", "x", "adj:sg:nom:m:pos", []), ("polski", "Polski", "adj:sg:nom:m:pos", ["nazwisko"]), ("ger", "ger", "ger:sg", ["marka"]), ("fin", "fin", "fin:sg", ["marka"]),
    ]
    corpus = [("Ala", "Ala", 3, "SGJP-LMM-CAPITAL", "NCH")]
    explicit = [("expl", "Expl", "capitalized"), ("dom", "Dom", "capitalized"), ("anna", "anna", "lowercase"), ("ala", "ala", "lowercase"), ("iść", "iść", "lowercase")]
    official = [("off", "Off", "capitalized"), ("mix", "Mix", "capitalized"), ("mix", "mix", "lowercase"), ("two", "Two", "capitalized"), ("two", "TWO", "capitalized"), ("same", "Same ", "capitalized"), ("same", "Same", "capitalized"), ("low", "other", "lowercase"), ("odd", "x", "strange"), ("a-b", "A-B", "capitalized")]
    module = [("mod", "Mod", "capitalized"), ("modlow", "x", "lowercase"), ("modmix", "a", "capitalized"), ("modmix", "b", "lowercase"), ("off", "off", "lowercase")]
    keys = ["dom", "nowy", "anna", "iść", "ala", "xx", "a-b", "polski", "ger", "fin", "expl", "off", "mix", "two", "same", "low", "odd", "mod", "modlow", "modmix", "no", "Dom"]
    got = {k: (r["surface"], r["reason"], r["resolved"], r["explicit_policy_conflict"]) for k, r in fold(spark, keys, corpus, an, explicit, official, module).items()}
    assert got == {
        "dom": ("dom", "common-noun", True, True), "nowy": ("nowy", "adjective", True, False), "anna": ("Anna", "proper-name", True, True), "iść": ("iść", "lexical", True, False), "ala": ("Ala", "secondary-capitalized", True, True),
        "xx": ("xx", "no-evidence", False, False), "a-b": ("A-B", "official-source", True, False), "polski": ("polski", "adjective", True, False), "ger": ("Ger", "proper-name", True, False), "fin": ("fin", "no-evidence", False, False),
        "expl": ("Expl", "explicit-policy", True, False), "off": ("Off", "official-source", True, False), "mix": ("mix", "official-policy-conflict", False, False), "two": ("two", "official-surface-conflict", False, False),
        "same": ("Same", "official-source", True, False), "low": ("low", "official-source", True, False), "odd": ("odd", "no-evidence", False, False), "mod": ("Mod", "module-policy", True, False), "modlow": ("modlow", "module-policy", True, False),
        "modmix": ("modmix", "module-policy-conflict", False, False), "no": ("no", "no-evidence", False, False),
    }


def test_secondary_chain(spark):
    """J8, then J7, then the key's own forms, then the key as a lemma; ties fall through."""
    corpus = [
        ("foos", "foo", 2, "", "NCH"), ("foos", "bar", 2, "", "NCH"), ("bars", "bar", 5, "SGJP-LMM-CAPITAL", "NCH"), ("bars", "zed", 9, "", "CW"), ("Tie", "Tie", 2, "", "PN"), ("tie", "tie", 2, "", "PN"),
        ("Up", "same", 3, "", "ACRO"), ("x", "same", 3, "", "ACRO"), ("one", "Own", 4, "", "NCH"), ("lex", "Lex", 4, "", "SPEC"),
    ]
    an = [("foos", "zed", "adv", []), ("bars", "bar", "adv", []), ("bars", "zed", "adv", []), ("Bars", "aaa", "adv", [])]
    got = {k: (r["secondary_policy"], r["secondary_basis"], r["secondary_lemma"]) for k, r in fold(spark, ["foos", "bars", "tie", "up", "own", "lex", "none"], corpus, an).items()}
    assert got == {
        "foos": ("capitalized", "lemma:sgjp-directional", "bar"),  # equal frequencies: the smaller lemma; zed is no capitalized verdict
        "bars": ("capitalized", "analysis:sgjp-directional", "bar"),
        "tie": (None, None, None),  # forms tie, lemma casing ties
        "up": ("lowercase", "lemma:lemma-casing", "same"),  # its forms tie under the lemma, whose own casing decides
        "own": ("capitalized", "own-lemma:lemma-casing", "own"), "lex": ("lowercase", "lemma:lexical", "lex"), "none": (None, None, None),
    }


def test_links_against_all_paths_with_split_lemmas(spark):
    rng = random.Random(3)
    letters = "abcde"
    corpus = [(rng.choice(letters) * rng.randint(1, 3), rng.choice("ABab") if rng.random() < 0.7 else "hot", rng.randint(1, 4), rng.choice(["SGJP-LMM-CAPITAL", "SGJP-LMM-LOWER", "", ""]), rng.choice(["CW", "PN", "SPEC", "NCH", "NCH", "NCH"])) for _ in range(150)]
    an = [(rng.choice(letters) * rng.randint(1, 3), rng.choice(["A", "b", "hot", ""]), "adv", []) for _ in range(30)]
    frame = tagged(spark, corpus)
    verdicts = E.lemma_verdicts(frame)
    found = {r["lemma"]: (r["policy"], r["basis"]) for r in verdicts.collect()}
    weights = defaultdict(Counter)
    for f, l, n, *_ in corpus:
        weights[f.lower()][l] += n
    want = {}
    for key in {*weights, *(o for o, *_ in an)}:
        j7 = next(((l.lower(), n, found[l.lower()][0]) for l, n in sorted(weights[key].items(), key=lambda x: (-x[1], x[0].lower())) if l.lower() in found), (None, None, None))
        j8 = next(((l, found[l][0]) for l in sorted({l.lower() for o, l, *_ in an if o == key and l}) if found.get(l, ("",))[0] == "capitalized"), (None, None))
        if j7[0] or j8[0]:
            want[key] = (*j7, *j8)
    for heavy, salts in ((1 / 200, 32), (0.0, 3), (1.0, 2)):
        got = {r["key"]: tuple(r)[1:] for r in E.linked(E.lemma_links(frame, spark.createDataFrame(an, ANALYSES), verdicts, heavy, salts)).collect()}
        assert got == want


def test_lattice(spark):
    sub, common = "subst:sg:nom:f", ["nazwa_pospolita"]
    an = [("a", "a", sub, common), ("A", "A", sub, ["nazwisko"]), ("b", "b", sub, common), ("B", "B", sub, ["nazwisko", "imię"]), ("c", "c", sub, common), ("C", "C", sub, ["marka"]), ("C", "C", sub, ["imię"]), ("d", "d", sub, common), ("e", "e", sub, ["marka"]),
          ("f", "f", sub, [*common, "marka"]), ("g", "g", sub, common), ("G", "G", "subst:sg:gen:f", ["marka"]), ("h", "h", sub, common), ("HH", "h", sub, ["marka"]), ("i", "i", sub, common), ("I", "I", "subst:sg:nom.acc:f", ["marka"])]
    frame = spark.createDataFrame(an, ANALYSES)
    classes = E.class_list(frame)
    assert classes == ["imię", "marka", "nazwisko"]
    got = {tuple(r) for r in E.class_lattice(E.class_masks(frame, classes), classes).collect()}
    assert got == {
        ("combination", "nazwisko", "surname-only", 1), ("combination", "imię + nazwisko", "mixed", 1), ("combination", "imię + marka", "non-surname", 1),
        ("class", "imię", None, 2), ("class", "marka", None, 1), ("class", "nazwisko", None, 2),
    }
    with pytest.raises(ValueError):
        E.class_list(frame, most=2)


def test_one_shuffle_on_the_key_and_empty_tables(spark):
    plan = E.resolve(spark.range(3).select(F.col("id").cast("string").alias("key"), F.lit(True).alias("asked"), *(F.lit(1).cast("long").alias(f"w_{w}") for w in E.WEIGHTS), F.lit(None).cast("struct<policy:string,basis:string>").alias("own"), F.lit("x").alias("lemma"), F.lit(1).cast("long").alias("n"), F.lit("corpus").alias("hop"), F.lit("capitalized").alias("policy"), F.lit("b").alias("basis"), *(F.lit(False).alias(c) for c in ("is_common", "is_adjective", "is_name", "is_lexical"))))
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert fold(spark, []) == {} and fold(spark, ["a"])["a"]["reason"] == "no-evidence"


def test_forms_of_keys_are_those_of_the_corpus(spark, tmp_path):
    from wordloom.plans import derived, registry_catalog

    for t, text in (("documents", "Kot kot-Pies LAS"), ("conversations", "kot LAS las")):
        spark.createDataFrame([(text,)], "text string").write.parquet(str(tmp_path / f"{t}.parquet"))
    keys = spark.createDataFrame([("kot",), ("las",), ("las",), ("pies",)], "key string")
    got = registry_catalog._forms_of(spark, str(tmp_path), keys)
    assert sorted(map(tuple, got.collect())) == [("conversations", "LAS", 1), ("conversations", "kot", 1), ("conversations", "las", 1), ("documents", "Kot", 1), ("documents", "LAS", 1)]
    # Digests are drawn from the staged forms: no plan over them reads the texts.
    assert "text" not in derived.analyses(got)._jdf.queryExecution().optimizedPlan().toString()
