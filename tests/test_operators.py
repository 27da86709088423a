"""Literal rows with the edge cases of each operator."""

import re

import pytest
from pyspark.sql import functions as F

from wordloom.config import WESTERN, LexiconConfig
from wordloom.functions import records as R
from wordloom.functions import text as X
from wordloom.operators import casing, counts, coverage, gates, history, modules, profiles, registry, selecting
from wordloom.plans import catalog
from wordloom.sources import readers, writers
from wordloom.streaming import streams

PL = LexiconConfig()


def one(spark, expr, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(expr.alias("x")).first()["x"]


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_components_and_hyphens(spark):
    a = F.col("a")
    assert one(spark, X.components(a), a="John's D'Arc Łódź") == ["John", "D", "Arc", "Łódź"]
    assert one(spark, X.components(a), a="JOHN’S car") == ["JOHN", "car"]
    assert one(spark, X.is_hyphenated(a), a="Ad‑Dauha") is True
    assert one(spark, X.is_hyphenated(a), a="a–b") is False and one(spark, X.is_hyphenated(a), a="-b") is False
    assert one(spark, X.hyphenated_surfaces(a), a="Doha, Ad-Dauha,Ad-Dauha") == ["Ad-Dauha"]
    assert one(spark, X.dictionary_surfaces(a), a="Ad-Dauha Ad") == ["Ad", "Dauha", "Ad", "Ad-Dauha Ad"]
    assert [tuple(x) for x in one(spark, X.component_records(a), a="x yz")] == [(1, "x"), (2, "yz")]


@pytest.mark.parametrize(
    ("a", "b", "kind"),
    [("kot", "kat", "substitution"), ("kto", "kot", "transposition"), ("abc", "cba", None), ("kot", "kot", None), ("kott", "kot", "deletion"), ("ko", "kot", "insertion"), ("été", "ete", None), ("été", "éte", "substitution"), ("ab", "ba", "transposition"), ("a", "", "deletion")],
)
def test_edit1_kind(spark, a, b, kind):
    assert one(spark, X.edit1_kind(F.col("a"), F.col("b")), a=a, b=b) == kind


def test_scalars(spark):
    a = F.col("a")
    assert one(spark, X.fold(a), a="ŻÓŁĆ") == "zolc"
    assert one(spark, X.canonical_name(a), a=" ANNA ") == "Anna" and one(spark, X.canonical_name(a), a="two words") is None
    assert one(spark, X.is_candidate(a), a="quo") is False and one(spark, X.is_candidate(a), a="żółw") is True
    assert one(spark, X.is_candidate(a), a="a" * 26) is False and one(spark, X.is_candidate(a), a="a" * 25) is True
    assert sorted(one(spark, X.single_deletes(a), a="aab")) == ["aa", "ab"] and one(spark, X.single_deletes(a), a="") == []
    assert one(spark, X.is_sg_nom_noun(a), a="subst:sg:nom.acc:n") is False and one(spark, X.is_sg_nom_noun(a, True), a="subst:sg:nom.acc:n") is True
    assert one(spark, X.tag_cases(a), a="subst:sg:nom.acc:n") == ["nom", "acc"] and one(spark, X.tag_cases(a), a="ign") == []
    assert one(spark, X.reason_class(a), a="typo->kot") == "typo" and one(spark, X.reason_class(a), a="foreign:en") == "foreign"
    assert one(spark, X.preserve_initial(a, F.lit("Ab")), a="kot") == "Kot"
    assert one(spark, X.is_inflection_surface(a), a="Nowy Sącz-Dolny") is True and one(spark, X.is_inflection_surface(a), a="Nowy Sącz") is False
    for text, n in (("1 234", 1234), ("1.234", 1234), ("1 234", 1234), ("", 0), ("x", None), ("-4", None)):
        assert one(spark, R.parse_count(a), a=text) == n
    assert one(spark, R.parse_count(a, signed=True), a="-4") == -4
    assert one(spark, R.casing_error(a, F.lit("lowercase")), a="Kot") == "not-lowercase" and one(spark, R.casing_error(a, F.lit("capitalized")), a="Kot") is None
    assert tuple(one(spark, R.parse_correction(a), a="ż -> w ogóle")) == ("ż", "w ogóle")
    assert tuple(one(spark, R.canonical_unit(a, F.lit("powiat"), F.lit("powiat")), a="Cieszyński")) == ("cieszyński", "lowercase")
    assert one(spark, R.classify_level(F.lit("02"), F.lit("01"), F.lit(None).cast("string"), F.lit(""), a), a="powiat") == "powiat"
    assert one(spark, R.normalize_gender(a), a="Kobieta") == "F" and one(spark, R.normalize_gender(a, "M"), a="?") == "M"


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "w.txt").write_text("# head\n\nkot\n Pies \n  # more\n")
    assert rows(readers.read_wordlist(spark, str(tmp_path / "w.txt")), "surface") == [("Pies",), ("kot",)]
    core, bad = readers.read_core(spark, str(tmp_path / "w.txt"), 3)
    assert rows(core, "key", "surface") == [("kot", "kot"), ("pies", "Pies")] and rows(bad, "gate", "detail") == [("size", "2")]
    (tmp_path / "t.tsv").write_text("  # note\n\na\tb\n02\t\nx\ty\n")
    assert rows(readers.read_tsv_commented(spark, str(tmp_path / "t.tsv"), ["a", "b"]), "a", "b") == [("02", ""), ("x", "y")]
    (tmp_path / "s.tsv").write_text("a\tb\n02\ty\n")
    assert rows(readers.read_tsv(spark, str(tmp_path / "s.tsv"), ["a", "b"]), "a", "b") == [("02", "y")]
    with pytest.raises(ValueError):
        readers.read_tsv(spark, str(tmp_path / "s.tsv"), ["a"])
    (tmp_path / "f.tsv").write_text("1\tkot\tkota; kotu ;\n")
    assert rows(readers.read_families(spark, str(tmp_path / "f.tsv")), "form") == [("kota",), ("kotu",)]
    (tmp_path / "k.txt").write_text("dictionary=main\n word=Kot,f=10\n word=quiz,f=9\nplain\n")
    assert rows(readers.read_keyboard_list(spark, str(tmp_path / "k.txt")), "word") == [("kot",)]
    assert readers.keyboard_statistics(spark, str(tmp_path / "k.txt")).first()["parsed"] == 1
    (tmp_path / "n.tsv").write_text("Kot\tkot\tsubst:sg:nom:m2\t5\t_\tSGJP-EXACT\tCW\tCORR\nzły\twiersz\nPies\tpies\tt\tx\t_\t_\t_\tCORR\n")
    assert rows(readers.read_tagged_frequency(spark, str(tmp_path / "n.tsv")), "form", "frequency") == [("Kot", 5)]
    (tmp_path / "r.xml").write_text('<c><row><WOJ>02</WOJ><NAZWA>Dolnośląskie</NAZWA><NAZDOD>województwo</NAZDOD></row><row WOJ="04"><col name="nazwa">Brzeg</col><col name="NAZWA_DOD">miasto</col></row></c>')
    got = rows(readers.read_registry_xml(spark, str(tmp_path / "r.xml")), "woj", "nazwa", "nazdod")
    assert got == [("02", "Dolnośląskie", "województwo"), ("04", "Brzeg", "miasto")]
    wide = spark.createDataFrame([("ANNA", "K", "1 000", "2")], "n string, g string, `2006` string, `2007` string")
    assert rows(readers.yearly_wide(wide, "n", "g"), "name", "gender", "year", "cnt") == [("Anna", "F", 2006, 1000), ("Anna", "F", 2007, 2)]
    tall = spark.createDataFrame([("Ala", "3", "K"), ("ALA", "4", "M")], "n string, c string, g string")
    summed, mixed = readers.yearly_tall(tall, "n", "c", 2020, "g")
    assert rows(summed, "gender", "cnt") == [("F", 3), ("M", 4)] and mixed.count() == 1
    writers.write_wordlist(spark.createDataFrame([("b",), ("a",), ("Ą",)], "surface string").coalesce(1), str(tmp_path / "out"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "out")).collect()] == ["a", "b", "Ą"]
    assert writers.source_manifest(spark, str(tmp_path / "w.txt")).first()["length"] > 0
    assert '"n":1' in writers.report_json(spark.createDataFrame([(1,)], "n int")).first()[0]
    writers.write_decisions(spark.createDataFrame([("a", "typo->b")], "word string, reason string"), str(tmp_path / "dec"))
    assert spark.read.parquet(str(tmp_path / "dec")).first()["reason_class"] == "typo"
    assert readers.find_column(["Imię pierwsze", "Liczba"], ["imie"]) == "Imię pierwsze"


def test_cascade_order_and_cut(spark):
    data = [("zzą", True, False, True, True, None, None), ("kąt", False, True, False, False, "en", None), ("cat", False, False, True, True, "en", None), ("dom", False, False, True, False, None, None), ("rżz", False, False, False, False, None, "róz"), ("rąk", False, False, False, False, None, None), ("dąb", False, False, True, False, None, None)]
    df = spark.createDataFrame(data, "word string, blocked boolean, guard boolean, spell boolean, keyboard boolean, rival string, typo_target string")
    got = {r["word"]: r["reason"] for r in selecting.cascade(df).collect()}
    assert got == {"zzą": "reviewed-typo-blocklist", "kąt": "guard", "cat": "foreign:en", "dom": "ascii-without-dual-evidence", "rżz": "typo->róz", "rąk": "no-positive-evidence", "dąb": "spell-evidence"}
    kept = spark.createDataFrame([("a", "keep", "x", 0, 1.0, False), ("b", "keep", "x", 1, 1.0, False), ("c", "keep", "x", 2, 1.0, True), ("d", "drop", "x", 3, 1.0, False)], "word string, decision string, reason string, rank int, zipf double, shield boolean")
    cut = {r["word"]: r["reason"] for r in selecting.capacity_cut(kept, 2, F.col("shield")).collect()}
    assert cut == {"a": "x", "b": "limit-cut", "c": "x", "d": "x"}
    with pytest.raises(ValueError):
        selecting.capacity_cut(kept, 0, F.col("shield"))


def test_protected_words_beyond_the_limit_displace_all_others(spark):
    data = [("a", 0, False, False), ("b", 1, True, True), ("c", 2, True, True), ("d", 3, False, True), ("e", 4, False, False), ("f", 5, True, False)]
    kept = spark.createDataFrame(data, "word string, rank int, added boolean, shield boolean").selectExpr("*", "'keep' decision", "'x' reason", "1.0D zipf")
    lost = selecting.displaced(kept, 2, F.col("added"), F.col("shield"), F.lit(False))
    assert rows(lost, "word") == [("a",)]  # three protected words, room for two: without the added ones a and d stay
    assert rows(selecting.displaced(kept, 3, F.col("added"), F.col("shield"), F.lit(False)), "word") == [("a",), ("e",)]
    full = selecting.capacity_cut(kept, 2, F.col("shield"), overfull=True)
    assert rows(full.where("decision = 'keep'"), "word") == [("b",), ("c",), ("d",)]


def test_alias_foreign_and_typo(spark):
    df = spark.createDataFrame([("ete", "keep", "x", 5.0, False, False), ("été", "keep", "x", 4.0, True, False), ("etê", "keep", "x", 4.5, False, False), ("pre", "keep", "x", 5.0, True, False), ("pré", "keep", "x", 4.0, True, False)], "word string, decision string, reason string, zipf double, spell boolean, keyboard boolean")
    got = {r["word"]: r["reason"] for r in selecting.suppress_aliases(df, WESTERN).collect()}
    assert got["ete"] == "x" and got["pre"] == "x"  # the best accented form lacks evidence; "pre" has its own
    z = spark.createDataFrame([("pl", "a", 2.0), ("en", "a", 3.0), ("pl", "b", 2.0), ("en", "b", 3.1), ("de", "b", 3.1), ("en", "c", 3.0), ("pl", "d", 3.5), ("en", "d", 6.0)], "lang string, word string, zipf double")
    assert rows(selecting.foreign_dominant(z, PL), "word", "rival") == [("b", "en"), ("c", "en")]
    zipfs = spark.createDataFrame([("kpt", 1.0), ("kot", 5.0), ("kit", 5.0), ("kopt", 1.0)], "word string, zipf double")
    known = spark.createDataFrame([("kot",), ("kit",)], "word string")
    assert rows(selecting.typo_targets(zipfs, known, PL), "word", "target") == [("kpt", "kit")]
    assert rows(selecting.typo_targets(zipfs, known, PL, indels=True), "word", "target") == [("kopt", "kot"), ("kpt", "kit")]


def test_typo_pairs_equal_brute_force(spark):
    import random

    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(3, 5))) for _ in range(150)})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {(r["word"], r["target"]) for r in selecting.typo_pairs(df, df).collect()}

    def near(a, b):
        d = [i for i in range(len(a)) if a[i] != b[i]]
        return len(d) == 1 or len(d) == 2 and d[1] == d[0] + 1 and a[d[0]] == b[d[1]] and a[d[1]] == b[d[0]]

    assert got == {(a, b) for a in words for b in words if a != b and len(a) == len(b) and near(a, b)}


def test_ranks_and_levels(spark):
    base = spark.createDataFrame([("b", 5), ("A", 7), ("c", 5)], "word string, cnt long")
    layer = spark.createDataFrame([("z",), ("b",), ("d",)], "word string")
    assert [tuple(r) for r in selecting.candidate_ranks(base, [layer]).orderBy("rank").select("rank", "word").collect()] == [(0, "a"), (1, "b"), (2, "c"), (3, "d"), (4, "z")]
    forms = [("powiat", "1", "x", "nom", "x"), ("powiat", "1", "x", "gen", "xa"), ("powiat", "1", "x", "loc", "xu"), ("gmina", "2", "y", "nom", "y"), ("gmina", "2", "y", "gen", "ya"), ("powiat", "3", "v", "nom", "v"), ("powiat", "3", "v", "gen", "va")]
    df = spark.createDataFrame(forms, "level string, code string, name string, case string, form string")
    none = spark.createDataFrame([("va", 2)], "word string, cnt long")
    z = spark.createDataFrame([("xu", 1.0), ("xa", 1.0)], "word string, zipf double")
    got = {r["form"]: r["retention"] for r in selecting.retain_by_level(df, none, z).collect()}
    assert got == {"x": "weighted-fallback", "xa": "weighted-fallback", "xu": "excluded-powiat-frequency-not-observed", "y": "nominative-only", "ya": "excluded-gmina-nominative-only", "v": "nkjp-observed", "va": "nkjp-observed"}
    audit = spark.createDataFrame([("a", True, True, True, 1.0, 1.0), ("b", False, True, True, 1.0, 1.0), ("c", False, False, False, 1.0, 1.0), ("d", False, False, True, 1.0, 3.0), ("e", False, False, True, 4.0, 0.0), ("f", False, False, True, 1.0, 0.0)], "word string, regression boolean, excluded boolean, in_preview boolean, zipf_own double, zipf_rival double")
    assert [r["audit_status"] for r in selecting.audit_status(audit, PL).orderBy("word").collect()] == ["BLOCKED_REGRESSION", "SOURCE_EXCLUDED", "NOT_IN_PREVIEW", "IN_PREVIEW_FOREIGN_SIGNAL", "IN_PREVIEW_COMMON_WORD_SIGNAL", "IN_PREVIEW_CLEAN_SIGNAL"]


TAGGED = "form string, lemma string, tag string, frequency long, morphology string, sgjp_status string, classification string, correctness string"


def test_secondary_verdicts(spark):
    t = lambda form, lemma, n, status="", cls="": (form, lemma, "t", n, "_", status, cls, "CORR")
    data = [t("Polska", "Polska", 3, "SGJP-LMM-CAPITAL", "CW"), t("dom", "Dom", 2, "", "CW"), t("Ala", "ala", 3, "", "PN"), t("ala", "Ala", 3, "", "PN"), t("Nowy", "nowy", 3, "", "NCH"), t("tie", "Tie", 1), t("tie", "tie", 1)]
    long = casing.evidence_long(spark.createDataFrame(data, TAGGED))
    got = {r["key"]: (r["surface"], r["basis"]) for r in casing.secondary_verdict(long).collect()}
    assert got == {"polska": ("Polska", "sgjp-directional"), "dom": ("dom", "common-word"), "nowy": ("nowy", "lemma-casing")}
    maps = {r["key"]: r["forms"] for r in casing.evidence_maps(long).collect()}
    assert maps["ala"] == {"Ala": 3, "ala": 3}
    assert rows(casing.case_weights(long), "key", "upper", "lower")[0] == ("ala", 3, 3)
    lemmas = spark.createDataFrame([("x", "b", 2), ("x", "a", 2), ("x", "c", 9)], "key string, lemma string, n long")
    v = spark.createDataFrame([("a", "A", "capitalized", "p"), ("b", "b", "lowercase", "q")], "key string, surface string, policy string, basis string")
    assert rows(casing.lemma_verdict(lemmas, v), "surface", "basis") == [("X", "lemma:p")]
    an = spark.createDataFrame([("x", "b"), ("x", "a")], "orth string, lemma string")
    assert rows(casing.analysis_lemma_verdict(an, v), "surface") == [("X",)]
    chain = casing.verdict_chain(lemmas, casing.analysis_lemma_verdict(an, v), casing.lemma_verdict(lemmas, v))
    assert chain.first()["basis"] == "analysis:p"


def test_resolver_order(spark):
    an = [("dom", "dom", "subst:sg:nom:m3", ["nazwa_pospolita"]), ("Dom", "Dom", "subst:sg:nom:m1", ["nazwisko"]), ("nowy", "nowy", "adj:sg:nom:m:pos", ["nazwa_geograficzna"]), ("Anna", "Anna", "subst:sg:nom:f", ["imię"]), ("iść", "iść", "inf:imperf", []), ("ala", "ala", "adv", [])]
    analyses = spark.createDataFrame(an, "orth string, lemma string, tag string, classes array<string>")
    keys = spark.createDataFrame([(k,) for k in ("dom", "nowy", "anna", "iść", "ala", "expl", "off", "mix", "two", "mod", "modmix", "no")], "key string")
    flags = casing.analysis_flags(keys, analyses)
    sp = "key string, surface string, policy string"
    secondary = spark.createDataFrame([("ala", "Ala", "capitalized"), ("no", "No", "capitalized")], sp)
    explicit = spark.createDataFrame([("expl", "Expl", "capitalized"), ("dom", "Dom", "capitalized")], sp)
    official = spark.createDataFrame([("off", "Off", "capitalized"), ("mix", "Mix", "capitalized"), ("mix", "mix", "lowercase"), ("two", "Two", "capitalized"), ("two", "TWO", "capitalized")], sp)
    module = spark.createDataFrame([("mod", "Mod", "capitalized"), ("modmix", "a", "capitalized"), ("modmix", "b", "lowercase")], sp)
    out = casing.resolve(keys, flags, secondary, explicit, official, module)
    got = {r["key"]: (r["surface"], r["reason"]) for r in out.collect()}
    assert got == {
        "dom": ("dom", "common-noun"), "nowy": ("nowy", "adjective"), "anna": ("Anna", "proper-name"), "iść": ("iść", "lexical"), "ala": ("Ala", "secondary-capitalized"), "expl": ("Expl", "explicit-policy"), "off": ("Off", "official-source"),
        "mix": (None, "official-policy-conflict"), "two": (None, "official-surface-conflict"), "mod": ("Mod", "module-policy"), "modmix": (None, "module-policy-conflict"), "no": (None, "no-evidence"),
    }
    assert casing.neutral_lowercase(out).where("key = 'no'").first()["surface"] == "no"
    assert rows(casing.dual_casing(flags), "key") == [("dom",)]
    each, combos = casing.class_distribution(casing.dual_casing(flags))
    assert rows(each, "class", "n") == [("nazwisko", 1)] and rows(combos, "kind", "n") == [("surname-only", 1)]
    assert rows(casing.homonym_audit(spark.createDataFrame([("Dom",), ("Anna",)], "name string"), analyses), "name") == [("Dom",)]


def test_registry(spark):
    src = spark.createDataFrame([("Nowy Sącz", "capitalized"), ("nowy", "lowercase")], "surface string, policy string")
    ok, bad = registry.canonicalize(src)
    assert rows(ok, "surface") == [("Sącz",)] and bad.count() == 1
    assert rows(registry.canonicalize(src, conflict_mode="prefer_lowercase")[0], "surface") == [("Sącz",), ("nowy",)]
    sp = "key string, surface string, policy string"
    a = spark.createDataFrame([("a", "A", "capitalized"), ("b", "b", "lowercase"), ("c", "C", "capitalized")], sp)
    b = spark.createDataFrame([("b", "B", "capitalized"), ("c", "c", "lowercase"), ("x", "X", "capitalized")], sp)
    kept = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "word string")
    reg = registry.build_registry({"s1": a, "s2": b}, kept)
    got = {r["key"]: (r["surface"], r["basis"], r["conflict"]) for r in registry.resolve_registry(reg, core=spark.createDataFrame([("c", "Z", "capitalized")], sp)).collect()}
    assert got == {"a": ("A", "source", False), "b": (None, "conflict", True), "c": ("Z", "core-audit", True), "d": ("d", "ordinary-vocabulary", False)}
    ks = "key string, surface string"
    merged, missing = registry.merge_modules(spark.createDataFrame([("a", "A")], ks), spark.createDataFrame([("a", "a"), ("b", "b")], ks), spark.createDataFrame([("b", "B"), ("c", "C")], ks))
    assert rows(merged, "key", "surface") == [("a", "A"), ("b", "b"), ("c", "C")] and missing.count() == 0
    flags = spark.createDataFrame([("a", True, None)], "key string, common_noun boolean, proper_name boolean")
    entry = registry.variant_entries(merged, a, flags).where("key = 'a'").first()["entry"]
    assert '"variants":["A"]' in entry and "properName" not in entry


def test_modules_and_paradigms(spark):
    base = spark.createDataFrame([("kot",), ("Pies",)], "surface string")
    mods = spark.createDataFrame([(1, "m1", "Kot"), (1, "m1", "kot"), (1, "m1", "lew"), (2, "m2", "lew"), (2, "m2", "ryś")], "ord int, module string, surface string")
    got = [tuple(r) for r in modules.module_costs(base, mods).orderBy("ord").collect()]
    assert got == [(1, "m1", 3, 2, 1, 1, 1, 1, 1, 0), (2, "m2", 2, 2, 0, 0, 0, 2, 1, 1)]
    assert tuple(modules.module_union(base, mods).first()) == (3, 1, 2, 4)
    an = [("Anny", "Anna", "subst:sg:gen:f"), ("Annie", "Anna", "subst:sg:dat.loc:f"), ("Ann", "Anna", "subst:pl:gen:f"), ("Anna", "Anna", "subst:sg:nom:f")]
    analyses = spark.createDataFrame(an, "orth string, lemma string, tag string")
    names = spark.createDataFrame([("Anna",)], "name string")
    made = modules.paradigm(names, analyses)
    assert rows(made, "case", "form") == [("dat", "Annie"), ("gen", "Anny"), ("loc", "Annie"), ("nom", "Anna")]
    assert modules.reverse_validated(made.union(spark.createDataFrame([("Anna", "gen", "Annny")], "name string, case string, form string")), analyses).count() == 4
    assert modules.case_coverage(made).first()["cases"] == ["nom", "gen", "dat", "loc"]
    reviewed = spark.createDataFrame([("Anna", "gen", "Aniny", "rev"), ("Ela", "gen", "Eli", "rev")], "name string, case string, form string, source string")
    merged, unknown = modules.with_overrides(made, reviewed)
    assert rows(merged.where("case = 'gen'"), "form", "source") == [("Aniny", "rev"), ("Anny", "rev")] and unknown.count() == 1
    cf = spark.createDataFrame([("bielsko", "gen", "bielska"), ("biała", "gen", "białej"), ("biała", "dat", "białej"), ("bielsko", "nom", "bielsko"), ("biała", "nom", "biała")], "component string, case string, form string")
    assert rows(modules.aligned_products(spark.createDataFrame([("Bielsko-Biała",)], "name string"), cf), "case", "form") == [("gen", "Bielska-Białej")]
    assert rows(modules.last_component_inflected(spark.createDataFrame([("nowo-Biała",)], "name string"), cf), "case", "form") == [("dat", "nowo-Białej"), ("gen", "nowo-Białej"), ("nom", "nowo-Biała")]
    cities = spark.createDataFrame([("Aa",), ("Bb",), ("Cc-Dd",), ("Ee",)], "name string")
    z = spark.createDataFrame([("bb", 3.0)], "word string, zipf double")
    assert rows(modules.selected_cities(cities, z, spark.createDataFrame([("Ee",)], "name string"), 1), "name") == [("Bb",), ("Cc-Dd",), ("Ee",)]
    units = spark.createDataFrame([("A", "1"), ("a", "2"), ("b", "3")], "name string, code string")
    assert tuple(modules.shared_names(units).first()) == (2, 1)


def test_history(spark):
    data = [("F", "A", 2024, 5), ("F", "B", 2024, 5), ("F", "A", 2025, 0), ("F", "B", 2025, 9)]
    sums = history.yearly_sums(spark.createDataFrame(data, "grp string, name string, year int, cnt long"))
    feats = history.features(history.yearly_rank(sums), 2025, recent=1)
    got = {r["name"]: (r["cumulative_count"], r["years_present"], r["recent_count"], r["year_ranks"]) for r in feats.collect()}
    assert got == {"A": (5, 2, 0, {"2024": 1, "2025": 2}), "B": (14, 2, 9, {"2024": 2, "2025": 1})}
    ranked = history.cumulative_rank(feats)
    assert rows(history.core_and_buffer(ranked, 1, 2), "name", "band") == [("A", "buffer"), ("B", "core")]
    assert rows(history.thresholds(ranked, (1, 5)), "n", "name") == [(1, "B"), (5, "A")]


def test_coverage_and_gates(spark):
    names = spark.createDataFrame([("city", "Łódź"), ("name", "Anna"), ("name", "Ola"), ("city", "anna")], "kind string, canonical string")
    pack = spark.createDataFrame([("Łódź",), ("anna",), ("ANNA",)], "surface string")
    got = {r["canonical"]: (r["status"], r["current_variants"]) for r in coverage.coverage_status(names, pack, pack.limit(1)).collect()}
    assert got["Łódź"][0] == "canonical_present" and got["Anna"] == ("lowercase_only", ["ANNA", "anna"]) and got["Ola"] == ("missing_from_pack", [])
    assert rows(coverage.kind_collisions(names), "key") == [("anna",)]
    kr = "key string, rank int"
    assert rows(coverage.snapshot_diff(spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], kr), spark.createDataFrame([("b", 2), ("c", 4), ("d", 5)], kr)), "key", "change") == [("a", "removed"), ("c", "rank_changed"), ("d", "added")]
    pop = spark.createDataFrame([("Ola", 7)], "name string, population long")
    z = spark.createDataFrame([("anna", 4.5)], "word string, zipf double")
    t = [(r["canonical"], r["population"], r["zipf"]) for r in coverage.triage(names, pop, z, PL).collect()]
    assert t == [("Ola", 7, None), ("Łódź", None, None), ("Anna", None, 4.5), ("anna", None, 4.5)]
    assert gates.cardinality(names, {"city": 2, "name": 3}, F.col("kind")).where("not ok").count() == 1
    with pytest.raises(gates.GateError):
        gates.strict(gates.domain(names, "kind", ["city"]), "kinds")
    assert gates.duplicates(names, ["canonical"], fold_case=True).count() == 1
    bad, summary = gates.casing_gate(spark.createDataFrame([("Kot", "lowercase"), ("Ala", "capitalized")], "surface string, policy string"))
    assert bad.count() == 1 and tuple(summary.first()) == (2, 2, 1)
    ksp = "key string, surface string, policy string"
    assert gates.agreement(spark.createDataFrame([("a", "a", "lowercase")], ksp), spark.createDataFrame([("a", "A", "capitalized")], ksp)).count() == 1
    assert gates.text_file_gate(spark.createDataFrame([("a\r",), ("b\x01",)], "value string")).first()["ok"] is False
    w = "word string"
    assert tuple(gates.overlap(spark.createDataFrame([("a",), ("b",)], w), spark.createDataFrame([("b",), ("c",)], w)).first()) == (2, 2, 1, 1, 1)
    assert gates.evidence_union(spark.createDataFrame([("a",)], w), spark.createDataFrame([("a",)], w)).count() == 1


def test_percentiles_and_corrections(spark):
    p = lambda *x: counts.percentiles(spark.createDataFrame([(float(v),) for v in x], "v double"), "v").first()
    assert p(1, 2, 7, 24, 51)["p10"] == 1.4 and p(1, 2, 7, 24, 51)["p90"] == 40.2 and p(3)["p95"] == 3 and p()["p50"] is None
    docs = spark.createDataFrame([(1, "Teh  cat\nteh"), (2, None)], "doc_id long, text string")
    fix = spark.createDataFrame([("teh", "the")], "wrong string, canonical string")
    assert [tuple(r) for r in counts.apply_corrections(docs, fix).orderBy("doc_id").collect()][0] == (1, "the  cat\nthe", 2)
    m = spark.createDataFrame([("m", "Kot", "kot"), ("m", "Lew", "lew")], "module string, surface string, lemma string")
    seen = counts.seen_counts(m, spark.createDataFrame([("kot", 3)], "form string, cnt long"), spark.createDataFrame([("kot", "kot", 2)], "form string, lemma string, cnt long"))
    assert rows(seen, "surface", "surface_count", "seen") == [("Kot", 3, True), ("Lew", 0, False)]
    assert {r["surface"]: r["pair_count"] for r in seen.collect()} == {"Kot": 2, "Lew": None}
    assert tuple(counts.seen_summary(seen).first()) == ("m", 1, 1)


def test_profiles(spark):
    p = spark.createDataFrame([("std", None, ["core"], {"core": 1.0}), ("eng", "std", ["core", "eng"], {"core": 2.0, "eng": 3.0})], readers.PROFILE)
    got = {r["name"]: (r["modules"], r["priority"]) for r in profiles.resolve_profiles(p).collect()}
    assert got["eng"] == (["core", "eng"], {"core": 2.0, "eng": 3.0})
    terms = spark.createDataFrame([("eng", "beton", 2)], "module string, word string, frequency int")
    core = spark.createDataFrame([("kot", 5)], "word string, frequency int")
    assert rows(profiles.profile_vocabulary(profiles.resolve_profiles(p).where("name = 'eng'"), terms, core), "word", "score") == [("beton", 6.0), ("kot", 5.0)]
    s = "surface string"
    layers = {"a": spark.createDataFrame([("Kot",)], s), "b": spark.createDataFrame([("kot",), ("pies",)], s)}
    assert profiles.assemble(layers).count() == 3 and rows(profiles.assemble(layers, True), "layer", "surface") == [("a", "Kot"), ("b", "pies")]
    pred = spark.createDataFrame([(1, "default", 1, "x"), (1, "new", 1, "y"), (1, "new", 2, "x")], "case_id int, system string, rank int, surface string")
    gold = spark.createDataFrame([(1, "g", "y")], "case_id int, grp string, surface string")
    assert rows(profiles.ranking_evaluation(pred, gold), "system", "top1", "fixed") == [("default", 0, 0), ("new", 1, 1)]
    assert profiles.latency_percentiles(spark.createDataFrame([("a", 1.0), ("a", 3.0)], "s string, ms double"), ["s"]).first()["p50"] == 2.0


@pytest.mark.parametrize(("low", "up", "want"), [(12, 1, "lowercase"), (2, 8, "capitalized"), (8, 2, "lowercase"), (20, 20, "default"), (4, 0, "default"), (6, 5, "default")])
def test_preference(spark, low, up, want):
    df = spark.createDataFrame([(low, up)], "l long, u long")
    assert df.select(streams.preference(F.col("l"), F.col("u"), F.lit("default"))).first()[0] == want


def test_stream_equals_batch(spark, tmp_path):
    data = [(1, "kot", "kot")] * 6 + [(1, "ala", "Ala")] * 7 + [(2, "kot", "Kot")] * 2
    events = spark.createDataFrame(data, "user_id long, key string, surface string")
    events.repartition(3).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    q = streams.case_preferences(stream).writeStream.outputMode("complete").format("memory").queryName("prefs").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c1")).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("prefs").collect())) == sorted(map(tuple, streams.case_preferences(events).collect()))
    docs = spark.createDataFrame([("en", "a b a"), ("fr", "a")], "lang string, text string")
    docs.repartition(2).write.parquet(str(tmp_path / "d"))
    streams.incremental_word_counts(spark.readStream.schema(docs.schema).parquet(str(tmp_path / "d")), str(tmp_path / "t"), str(tmp_path / "c2")).awaitTermination()
    assert rows(streams.current_counts(spark, str(tmp_path / "t")), "lang", "word", "cnt") == rows(counts.word_counts(docs), "lang", "word", "cnt")


def test_long_correction_lists_give_the_same_texts(spark):
    docs = spark.createDataFrame([(1, "teh  cat\tOT x"), (1, "Teh teh"), (2, ""), (3, None), (None, "ot")], "doc_id long, text string")
    table = spark.createDataFrame([("teh", "the"), ("teh", "zzz"), ("ot", "to go")], "wrong string, canonical string")
    key = lambda r: tuple(str(x) for x in r)
    short, long = (sorted(map(key, counts.apply_corrections(docs, table, mapped=m).collect())) for m in (10, 0))
    assert short == long and ("1", "the  cat\tto go x", "2") in short and ("1", "the the", "2") in short
    assert counts.apply_corrections(docs, table.limit(0)).where("n_changed > 0").count() == 0


def test_attached_evidence_equals_joined(spark):
    words = spark.createDataFrame([("a", 1, 0.5), ("b", 2, None), ("c", 3, 1.0)], "word string, rank int, zipf double")
    sets = {"spell": spark.createDataFrame([("a",), ("a",), ("z",)], "word string"), "keyboard": spark.createDataFrame([("b",)], "word string")}
    rival = spark.createDataFrame([("c", "de"), ("c", "en"), ("y", "en")], "word string, rival string")
    got = selecting.attach_evidence(words, sets, {"rival": rival})
    assert got.columns == ["word", "rank", "zipf", "spell", "keyboard", "rival"]
    joined = selecting.with_evidence(words, sets)
    assert rows(got.drop("rival").where("zipf is not null"), *joined.columns) == rows(joined.where("zipf is not null"), *joined.columns)
    assert rows(got, "word", "rival")[2] == ("c", "en") and got.where("word = 'b' and keyboard and not spell and zipf is null").count() == 1


def test_single_tokens_and_genders(spark):
    names = spark.createDataFrame([("Łódź",), ("Nowy Sącz",), ("a-b",), (None,)], "name string")
    assert {r["name"]: r["eligible_single_token"] for r in selecting.single_token(names).collect()} == {"Łódź": True, "Nowy Sącz": False, "a-b": False, None: False}
    a = F.col("a")
    for mark, want in (("ŻEŃSKA", "F"), ("płeć męska", "M"), ("Kobiety", "F"), ("mężczyźni", "M"), ("female", "F"), ("k", "F"), ("?", None)):
        assert one(spark, R.normalize_gender(a), a=mark) == want


def test_broken_xml_rows_cost_no_others(spark, tmp_path):
    (tmp_path / "r.xml").write_text('<?xml version="1.0"?><c>\n<row><WOJ>02</WOJ><NAZWA>A</NAZWA><NAZDOD>powiat</NAZDOD></row>\n<row><WOJ>03</NAZWA></row><row WOJ="04" NAZWA="B" NAZDOD="gmina wiejska"/><row><col>05</col><col/><col/><col/><col>C &amp; D</col><col>powiat</col><col>2020</col></row><row><col>06</col><col>short</col></row><row><col name="woj" value="07"/><col name="nazwa">E</col></row></c>')
    got = {r["woj"]: (r["nazwa"], r["rejected"]) for r in readers.registry_records(spark, str(tmp_path / "r.xml")).collect()}
    assert got == {"02": ("A", None), "04": ("B", None), "05": ("C & D", None), "07": ("E", "no-nazdod"), None: (None, "no-woj")} or got[None][1] in ("broken-xml", "no-woj")
    by = {r["rejected"]: r["count"] for r in readers.registry_records(spark, str(tmp_path / "r.xml")).groupBy("rejected").count().collect()}
    assert by == {None: 3, "broken-xml": 1, "no-woj": 1, "no-nazdod": 1}
    (tmp_path / "g.xml").write_text("<a><gml:featureMember><gml:name> X </gml:name><gml:genitive>Y</gml:genitive></gml:featureMember><gml:featureMember><gml:name/></gml:featureMember></a>")
    assert rows(readers.read_gazetteer_xml(spark, str(tmp_path / "g.xml"), "gml:featureMember"), "name", "genitive") == [("X", "Y")]


def test_yearly_tables_by_their_header(spark, tmp_path):
    (tmp_path / "w.csv").write_text("Imię,Płeć,2001,2002\nANNA,K,1 000,2\nANNA,żeńska,,3\nX1,K,1,1\nJAN,?,1,1\nEWA,K,x,4\n")
    good, bad = readers.read_yearly(spark, str(tmp_path / "w.csv"), range(2001, 2003))
    assert rows(good, "name", "gender", "year", "cnt") == [("Anna", "F", 2001, 1000), ("Anna", "F", 2002, 5), ("Ewa", "F", 2002, 4)]
    assert rows(bad.groupBy("rejected").count(), "rejected", "count") == [("count", 1), ("gender", 2), ("name", 2)]
    (tmp_path / "t.csv").write_text("IMIE,PLEC,Rok,Liczba\nANNA,K,2001,7\nANNA,K,2001,1\nANNA,K,1950,7\nJAN,M,rok,1\n")
    good, bad = readers.read_yearly(spark, str(tmp_path / "t.csv"), range(2001, 2003))
    assert rows(good, "name", "year", "cnt") == [("Anna", 2001, 8)] and rows(bad, "raw_year", "rejected") == [("rok", "year")]


def test_bigram_weights_do_not_deal_all_pairs_by_language(spark):
    docs = spark.createDataFrame([("en", "a b a b c"), ("fr", "x y"), ("en", None)], "lang string, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = counts.bigrams(docs)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert sorted(map(tuple, got.select("lang", "previous", "current", "cnt", "weight").collect())) == [("en", "a", "b", 2, 1000), ("en", "b", "a", 1, 500), ("en", "b", "c", 1, 500), ("fr", "x", "y", 1, 1000)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pairs_are_sorted_by_word_before_language_and_read_in_small_pieces(spark, tmp_path):
    docs = spark.createDataFrame([(1, "en", "a b a b c"), (2, "fr", "b a, b c"), (3, "en", "a d a c"), (4, "en", None), (5, "fr", "x")], "doc_id long, lang string, text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = catalog.bigram_topk(spark, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    # A count or a sort that leaves memory compares the first eight bytes of its first key: a language has one value there.
    firsts = [x for x in re.findall(r"(?:HashAggregate\(keys=|Sort )\[([^\]]*)\]", plan) if "," in x]
    assert len(firsts) >= 4 and not [x for x in firsts if x.startswith("lang")]
    assert "hashpartitioning(doc_id#" in plan and f", {counts.PIECES}), REPARTITION_BY_NUM" in plan
    want = [("en", "a", "b", 2, 1, 1000), ("en", "a", "c", 1, 2, 500), ("en", "a", "d", 1, 3, 500), ("en", "b", "a", 1, 1, 500), ("en", "b", "c", 1, 2, 500), ("en", "d", "a", 1, 1, 500)]
    want += [("fr", "a", "b", 1, 1, 1000), ("fr", "b", "a", 1, 1, 1000), ("fr", "b", "c", 1, 2, 1000)]
    assert rows(got, "lang", "previous", "current", "cnt", "position", "weight") == want
