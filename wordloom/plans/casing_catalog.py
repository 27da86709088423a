"""Queries over derived evidence: the casing fold, two-hop lemma links, counters, the class lattice, registry evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordloom.operators import evidence_fold as E
from wordloom.operators import selecting
from wordloom.plans import derived as D
from wordloom.sources.writers import settled

EXPLICIT, OFFICIAL, MODULE = ("e", (3,)), ("o", (5, 4)), ("w", (4, 3))


def _forms(spark, d):
    return settled(D.forms(spark, d), "forms")


def _corpus(forms):
    return selecting.correct_rows(D.tagged(forms))


def _resolved(spark, d):
    forms = _forms(spark, d)
    # Each is read by several branches of the union: drawn once, as every branch would else draw all digests again.
    corpus, keys = settled(_corpus(forms), "tagged"), settled(forms.select(F.lower("form").alias("form")).distinct(), "keys")
    rows = E.evidence(keys.select(F.col("form").alias("key")), corpus, settled(D.analyses(keys), "analyses"), *(D.policies(keys, *p) for p in (EXPLICIT, OFFICIAL, MODULE)))
    return E.resolve(rows)


def casing_fold(spark, d):
    """R5-R9 with J7, J8: one decision a key."""
    return _resolved(spark, d)


def casing_reasons(spark, d):
    return _resolved(spark, d).groupBy("reason", "policy", "secondary_basis").agg(F.count("*").alias("n"), F.count_if("explicit_policy_conflict").alias("conflicts"), F.count_if(~F.col("resolved")).alias("fallbacks"))


def lemma_hops(spark, d):
    """J7 and J8."""
    forms = _forms(spark, d)
    corpus = settled(_corpus(forms), "tagged")
    return E.linked(E.lemma_links(corpus, D.analyses(forms), settled(E.lemma_verdicts(corpus), "lemma-verdicts")))


def class_lattice(spark, d):
    """A16 over R10 and R11."""
    analyses = D.analyses(_forms(spark, d))
    classes = E.class_list(analyses)
    return E.class_lattice(E.class_masks(analyses, classes), classes)


def analysis_classes(spark, d):
    """What the analyses say of each key."""
    any_ = lambda c: F.bool_or(c).alias(c)
    return E.analysis_marks(D.analyses(_forms(spark, d))).groupBy("key").agg(*map(any_, ("is_common", "is_adjective", "is_name", "is_lexical")))


QUERIES = {f.__name__: f for f in (casing_fold, casing_reasons, lemma_hops, class_lattice, analysis_classes)}

_BASE = f"WITH {D.FORMS_SQL}, {D.TAGGED_SQL}, {D.ANALYSES_SQL}"


def _weights(key: str, name: str) -> str:
    """R7 by key: policy and basis."""
    s = lambda cond, n: f"coalesce(sum(frequency) FILTER ({cond}), 0) AS {n}"
    sums = ", ".join([
        s("sgjp_status = 'SGJP-LMM-CAPITAL'", "su"), s("sgjp_status IN ('SGJP-LMM-UNCAPITAL', 'SGJP-LMM-LOWER', 'SGJP-BTH-LOWER')", "sl"), s("classification = 'CW'", "cw"), s("classification IN ('PN', 'ACRO', 'WEB')", "pn"),
        s("classification IN ('SPEC', 'NEOL', 'EXT', 'SYMB', 'COMPD')", "lx"), s(r"regexp_matches(form, '^\p{Lu}')", "fu"), s(r"regexp_matches(form, '^\p{Ll}')", "fl"), s(r"regexp_matches(lemma, '^\p{Lu}')", "lu"), s(r"regexp_matches(lemma, '^\p{Ll}')", "ll"),
    ])
    return f"""{name}0 AS (SELECT lower({key}) AS key, {sums} FROM ok GROUP BY 1),
{name} AS (SELECT key, CASE WHEN su > sl THEN 'capitalized' WHEN sl > su OR cw > 0 THEN 'lowercase' WHEN pn > 0 AND fu > fl THEN 'capitalized' WHEN pn > 0 AND fl > fu OR lx > 0 THEN 'lowercase' WHEN lu > ll THEN 'capitalized' WHEN ll > lu THEN 'lowercase' END AS policy,
  CASE WHEN su <> sl THEN 'sgjp-directional' WHEN cw > 0 THEN 'common-word' WHEN pn > 0 AND fu <> fl THEN 'proper-name-observed' WHEN lx > 0 THEN 'lexical' ELSE 'lemma-casing' END AS basis FROM {name}0)"""


_HOPS = f"""{_weights('form', 'rs')}, {_weights('lemma', 'rl0')}, rl AS (SELECT * FROM rl0 WHERE policy IS NOT NULL),
c7 AS (SELECT lower(form) AS key, lemma AS cased, lower(lemma) AS lemma, sum(frequency) AS n FROM ok GROUP BY ALL),
j7 AS (SELECT c7.key, c7.lemma, n, policy, basis, row_number() OVER (PARTITION BY c7.key ORDER BY n DESC, c7.lemma) AS k FROM c7 JOIN rl ON rl.key = c7.lemma),
j8 AS (SELECT a.key, a.lemma, policy, basis, row_number() OVER (PARTITION BY a.key ORDER BY a.lemma) AS k FROM (SELECT DISTINCT orth AS key, lower(lemma) AS lemma FROM an WHERE orth = lower(orth)) a JOIN rl ON rl.key = a.lemma WHERE policy = 'capitalized')"""

_ORDINARY = "('subst', 'adj', 'adv', 'verb', 'part', 'prep', 'conj', 'num', 'ger', 'ppron', 'pron')"
_PROBE = f"(orth = lower(orth) OR orth = {D._upper_first('lower(orth)')})"
_MARKS = f"""mk0 AS (SELECT lower(orth) AS key, split_part(tag, ':', 1) AS pos, list_contains(classes, 'nazwa_pospolita') AS c, list_filter(classes, lambda x: x NOT IN ('', 'nazwa_pospolita')) AS names FROM an WHERE {_PROBE} AND NOT regexp_matches(lower(orth), '[-‐‑]')),
mk AS (SELECT key, bool_or(pos IN {_ORDINARY} AND c) AS is_common, bool_or(pos = 'adj') AS is_adjective, bool_or(pos IN {_ORDINARY} AND len(names) > 0 AND (pos <> 'adj' OR list_contains(names, 'nazwisko'))) AS is_name, bool_or(pos NOT IN ('ign', 'interp') AND len(names) = 0) AS is_lexical FROM mk0 GROUP BY key)"""


def _grouped(name: str, source: str) -> str:
    return f"{name} AS (SELECT key, bool_or(policy = 'capitalized') AS up, bool_or(policy = 'lowercase') AS low, min(surface) AS a, max(surface) AS z FROM {source} GROUP BY key)"


_FOLD = f"""{_BASE}, {_HOPS}, {_MARKS}, {D.policies_sql('ex', *EXPLICIT)}, {D.policies_sql('of0', *OFFICIAL)}, {D.policies_sql('mo0', *MODULE)}, {_grouped('of_', 'of0')}, {_grouped('mo', 'mo0')},
al AS (SELECT kk.key, coalesce(is_common, false) AS ic, coalesce(is_adjective, false) AS ia, coalesce(is_name, false) AS iname, coalesce(is_lexical, false) AS il, ex.surface AS es, ex.policy AS ep, of_.up AS ou, of_.low AS ol, of_.a, of_.z, mo.up AS mu, mo.low AS ml,
  CASE WHEN j8.key IS NOT NULL THEN j8.policy WHEN j7.key IS NOT NULL THEN j7.policy WHEN rs.policy IS NOT NULL THEN rs.policy ELSE rl.policy END AS secondary_policy,
  CASE WHEN j8.key IS NOT NULL THEN 'analysis:' || j8.basis WHEN j7.key IS NOT NULL THEN 'lemma:' || j7.basis WHEN rs.policy IS NOT NULL THEN 'surface:' || rs.basis WHEN rl.key IS NOT NULL THEN 'own-lemma:' || rl.basis END AS secondary_basis,
  CASE WHEN j8.key IS NOT NULL THEN j8.lemma WHEN j7.key IS NOT NULL THEN j7.lemma WHEN rs.policy IS NOT NULL THEN NULL WHEN rl.key IS NOT NULL THEN kk.key END AS secondary_lemma
  FROM kk LEFT JOIN mk USING (key) LEFT JOIN ex USING (key) LEFT JOIN of_ USING (key) LEFT JOIN mo USING (key) LEFT JOIN j8 ON j8.key = kk.key AND j8.k = 1 LEFT JOIN j7 ON j7.key = kk.key AND j7.k = 1 LEFT JOIN rs ON rs.key = kk.key LEFT JOIN rl ON rl.key = kk.key),
rr AS (SELECT *, CASE WHEN ic THEN 'common-noun' WHEN ia THEN 'adjective' WHEN iname THEN 'proper-name' WHEN il AND coalesce(secondary_policy = 'capitalized', false) THEN 'secondary-capitalized' WHEN il THEN 'lexical' WHEN ep IS NOT NULL THEN 'explicit-policy'
  WHEN ol AND NOT ou THEN 'official-source' WHEN ou AND NOT ol AND a <> z THEN 'official-surface-conflict' WHEN ou AND NOT ol THEN 'official-source' WHEN ou AND ol THEN 'official-policy-conflict'
  WHEN ml AND NOT mu OR mu AND NOT ml THEN 'module-policy' WHEN mu AND ml THEN 'module-policy-conflict' ELSE 'no-evidence' END AS reason FROM al),
fold AS (SELECT key, reason NOT LIKE '%conflict' AND reason <> 'no-evidence' AS resolved,
  CASE WHEN reason IN ('proper-name', 'secondary-capitalized') THEN {D._upper_first('key')} WHEN reason = 'explicit-policy' THEN es WHEN reason = 'official-source' AND a = z THEN a WHEN reason = 'official-source' AND ou THEN {D._upper_first('key')} WHEN reason = 'module-policy' AND mu THEN {D._upper_first('key')} ELSE key END AS surface,
  CASE WHEN reason IN ('proper-name', 'secondary-capitalized') THEN 'capitalized' WHEN reason = 'explicit-policy' THEN ep WHEN reason = 'official-source' AND ou THEN 'capitalized' WHEN reason = 'module-policy' AND mu THEN 'capitalized' ELSE 'lowercase' END AS policy, reason,
  CASE WHEN reason IN ('common-noun', 'adjective', 'proper-name', 'lexical') THEN 'analysis' WHEN reason = 'secondary-capitalized' THEN 'corpus' WHEN reason = 'explicit-policy' THEN 'policy' WHEN reason LIKE 'official%' THEN 'official' WHEN reason LIKE 'module%' THEN 'module' ELSE 'none' END AS basis,
  coalesce(CASE WHEN reason IN ('common-noun', 'adjective', 'lexical') THEN ep <> 'lowercase' WHEN reason IN ('proper-name', 'secondary-capitalized') THEN ep <> 'capitalized' END, false) AS explicit_policy_conflict, secondary_policy, secondary_basis, secondary_lemma FROM rr)"""

_SG_NOM = "list_contains(string_split(tag, ':'), 'sg') AND list_contains(string_split(tag, ':'), 'nom') AND split_part(tag, ':', 1) = 'subst'"

ORACLE_SQL: dict[str, str] = {
    "casing_fold": f"{_FOLD} SELECT * FROM fold",
    "casing_reasons": f"{_FOLD} SELECT reason, policy, secondary_basis, count(*) AS n, count(*) FILTER (explicit_policy_conflict) AS conflicts, count(*) FILTER (NOT resolved) AS fallbacks FROM fold GROUP BY ALL",
    "lemma_hops": f"{_BASE}, {_HOPS}, a7 AS (SELECT * FROM j7 WHERE k = 1), a8 AS (SELECT * FROM j8 WHERE k = 1) SELECT coalesce(a7.key, a8.key) AS key, a7.lemma AS j7_lemma, a7.n AS j7_n, a7.policy AS j7_policy, a8.lemma AS j8_lemma, a8.policy AS j8_policy FROM a7 FULL JOIN a8 ON a7.key = a8.key",
    "class_lattice": f"""{_BASE}, sn AS (SELECT lower(orth) AS key, list_contains(classes, 'nazwa_pospolita') AS c, CASE WHEN list_contains(classes, 'nazwa_pospolita') THEN [] ELSE list_filter(classes, lambda x: x <> '') END AS names FROM an WHERE {_PROBE} AND {_SG_NOM}),
ks AS (SELECT key, list_sort(list_distinct(flatten(list(names)))) AS names FROM sn GROUP BY key HAVING bool_or(c) AND max(len(names)) > 0)
SELECT 'combination' AS level, array_to_string(names, ' + ') AS name, CASE WHEN names = ['nazwisko'] THEN 'surname-only' WHEN list_contains(names, 'nazwisko') THEN 'mixed' ELSE 'non-surname' END AS kind, count(*) AS n FROM ks GROUP BY names
UNION ALL SELECT 'class', c, NULL, count(*) FROM (SELECT unnest(names) AS c FROM ks) GROUP BY c""",
    "analysis_classes": f"{_BASE}, {_MARKS} SELECT * FROM mk",
}
