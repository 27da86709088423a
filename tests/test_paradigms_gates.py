"""Paradigms, first rows with their conflicts, and gates by observed figures."""

import itertools

import pytest
from pyspark.sql import functions as F

from wordloom.config import CASES
from wordloom.operators import casing, modules
from wordloom.operators.gates import GateError
from wordloom.operators.observed import Ledger, insist

ANALYSES = "orth string, lemma string, tag string, classes array<string>"


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_reverse_verdicts(spark):
    an = spark.createDataFrame([("Kota", "kot", "subst:sg:gen.acc:m2", None), ("kota", "kota", "subst:sg:nom:f", None), ("koty", "kot", "subst:pl:nom:m2", None), ("psa", "pies", "subst:sg:gen:m2", None), ("kocie", "kot", "fin:sg", None)], ANALYSES)
    forms = spark.createDataFrame([("Kot", "gen", "Kota"), ("Kot", "acc", "kota"), ("Kot", "dat", "Kota"), ("Kot", "nom", "Koty"), ("Kot", "gen", "psa"), ("Kot", "voc", "kotx"), ("Kot", "loc", "kocie"), ("Kot", "gen", "Kota")], "name string, case string, form string")
    assert rows(modules.reverse_checked(forms, an), "case", "form", "verdict") == sorted([("gen", "Kota", "valid"), ("acc", "kota", "valid"), ("dat", "Kota", "other-case"), ("nom", "Koty", "other-case"), ("gen", "psa", "other-lemma"), ("voc", "kotx", "unknown-form"), ("loc", "kocie", "other-case")])
    kept = modules.reverse_validated(forms, an)
    assert rows(kept.distinct(), "case", "form") == [("acc", "kota"), ("gen", "Kota")]
    assert rows(modules.case_gaps(forms.where("case in ('nom', 'gen')")), "case") == [(c,) for c in sorted(set(CASES) - {"nom", "gen"})]


def test_products_stay_bounded_at_every_step(spark):
    parts = {p: [f"{p}{i}" for i in range(6)] for p in "abcd"}
    forms = spark.createDataFrame([(p, c, f) for p, fs in parts.items() for f in fs for c in ("gen", "nom")] + [("z", "gen", "z")], "component string, case string, form string")
    names = spark.createDataFrame([("A-b-C-d",), ("A-z",), ("A-unknown",), ("a‑b",)], "name string")
    got = {}
    for r in modules.aligned_products(names, forms).collect():
        got.setdefault((r["name"], r["case"]), []).append(r["form"])
    first = [parts[p][:4] for p in "abcd"]
    up = [[f.capitalize() for f in first[0]], first[1], [f.capitalize() for f in first[2]], first[3]]
    made = ["-".join(x) for x in itertools.product(*up[:2])]
    for more in up[2:]:
        made = [f"{m}-{x}" for m in made for x in more][:64]
    assert sorted(got[("A-b-C-d", "gen")]) == sorted(made) and len(made) == 64
    assert sorted(got[("A-z", "gen")]) == [f"A{i}-z" for i in range(4)] and ("A-z", "nom") not in got and not any(n == "A-unknown" for n, _ in got)
    assert len(got[("a‑b", "gen")]) == 16 and all("‑" in f for f in got[("a‑b", "gen")])


def test_first_rows_and_their_conflicts(spark):
    data = [(3, "Łódź"), (1, "ŁÓDŹ"), (2, "łódź"), (5, "łódź"), (4, "kot"), (6, "kot")]
    first, bad = casing.keep_first(spark.createDataFrame(data, "at int, name string").repartition(3), "name", ["at"], "name")
    assert rows(first, "key", "at", "name") == [("kot", 4, "kot"), ("łódź", 1, "ŁÓDŹ")]
    assert rows(bad, "value", "rows", "kept") == sorted([("ŁÓDŹ", 1, True), ("Łódź", 1, False), ("łódź", 2, False)])


def test_first_rows_by_one_number_equal_those_by_structs(spark):
    low, high = -(2**63), 2**63 - 1
    docs = [None, low, low + 1, -1, 0, 1, 2, high - 1, high]
    data = [(d, at, s) for i, s in enumerate(("Kot", "kot", "KOT", "ŁÓDŹ", "łódź", "pies", None)) for j, d in enumerate(docs) if (i * 5 + j) % 3 for at in (None, -(2**31), -1, 0, 2**31 - 1)[(i + j) % 5 :]]
    data += [(5, 5, "Żuk"), (5, 5, "żuk"), (None, None, "Oko"), (None, None, "oko"), (low, -(2**31), "Ul"), (low, None, "ul")]
    df = spark.createDataFrame(data, "doc long, at int, s string").repartition(5)
    first, bad = casing.keep_first(df, "s", ["doc", "at"], "s")
    plain, plain_bad = casing.keep_first(df.withColumn("zz", F.lit(0)), "s", ["doc", "at"], "s")
    values = lambda f, *c: sorted(map(str, f.select(*c).collect()))
    assert values(first, "key", "doc", "at", "s") == values(plain, "key", "doc", "at", "s") and first.columns == ["doc", "at", "s", "key"]
    assert values(bad, "key", "value", "rows", "kept") == values(plain_bad, "key", "value", "rows", "kept")
    one, _ = casing.keep_first(df.select("doc", "s"), "s", ["doc"], "s")
    assert values(one, "key", "doc", "s") == values(casing.keep_first(df.selectExpr("doc", "s", "0 zz"), "s", ["doc"], "s")[0], "key", "doc", "s")
    # The numbers are ranked by a hash aggregate, structs by a sort of all rows.
    place, _ = casing._place(df, ["doc", "at"])
    plan = lambda f: f._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in plan(df.groupBy("s").agg(F.min(place))) and "SortAggregate" in plan(df.groupBy("s").agg(F.min(F.struct("doc", "at"))))


def test_ledger_counts_while_writing(spark, tmp_path):
    book = Ledger()
    df = spark.range(100).withColumn("odd", F.col("id") % 2 == 1).repartition(4)
    book.step("all", df, odd=F.count_if("odd")).write.parquet(str(tmp_path / "all"))
    book.step("odd", spark.read.parquet(str(tmp_path / "all")).where("odd")).write.parquet(str(tmp_path / "odd"))
    assert (book["all", "rows"], book["all", "odd"], book["odd", "rows"]) == (100, 50, 50)
    good = book.balance(spark, {"odd": (lambda b: b["all", "odd"], lambda b: b["odd", "rows"])})
    insist(good)
    assert rows(good, "gate", "expected", "actual", "ok") == [("odd", 50, 50, True)]
    with pytest.raises(GateError, match="all-kept: 100 expected, 50 found"):
        insist(book.balance(spark, {"all-kept": (lambda b: b["all", "rows"], lambda b: b["odd", "rows"])}))
    with pytest.raises(ValueError):
        book.step("odd", df)
    empty = Ledger()
    empty.step("none", df.where("id < 0"), top=F.max("id")).write.parquet(str(tmp_path / "none"))
    assert (empty["none", "rows"], empty["none", "top"]) == (0, 0)


def test_a_made_up_name_that_the_corpus_holds_stays_unknown(spark, tmp_path):
    import hashlib

    from tests.compare import TABLES, differences
    from wordloom.plans import paradigm_catalog

    digit = lambda salt, word, i=1: int(hashlib.md5((salt + word).encode()).hexdigest()[i - 1], 16)
    name = next(n for n in map("".join, itertools.product("abcde", repeat=5)) if digit("r", n.capitalize()) < 4 and digit("r", n.capitalize(), 3) < 4)
    # The stem of one of these, cut by two or three letters, is the name with the made-up ending.
    held = next(w for k in (2, 3) for tail in itertools.product("abcdefgh", repeat=k) if 2 + digit("s", w := name + "xq" + "".join(tail)) % 2 == k)
    for t in TABLES:
        spark.createDataFrame([(1, f"{name} {held}")], "id long, text string").write.parquet(str(tmp_path / f"{t}.parquet"))
    got = paradigm_catalog.paradigm_overrides(spark, str(tmp_path))
    assert (name.capitalize() + "xq", "nom") in rows(got, "name", "case")
    assert [r["source"] for r in got.where((F.col("name") == name.capitalize() + "xq") & (F.col("form") == name.capitalize())).collect()] == ["unknown-name"]
    assert differences(got, paradigm_catalog.ORACLE_SQL["paradigm_overrides"], str(tmp_path)) is None
