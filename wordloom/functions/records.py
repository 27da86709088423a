"""Column functions over source records: counts, genders, registry codes, corrections, casing checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Kinds of units and the last digit of a commune's code.
COUNTY_KINDS = ("powiat", "miasto na prawach powiatu", "miasto stołeczne, na prawach powiatu")
COMMUNE_KINDS = ("gmina miejska", "gmina wiejska", "gmina miejsko-wiejska", "miasto stołeczne", "gmina miejska, miasto stołeczne")
COMMUNE_TYPES = ("1", "2", "3")
# Marks of gender and stems of such marks.
FEMALE, FEMALE_STEMS = ("k", "f", "female"), ("kobiet", "zensk")
MALE, MALE_STEMS = ("m", "male"), ("mezczy", "mesk")


def parse_count(x: Column, signed: bool = False) -> Column:
    """a count without group marks; empty is 0; NULL marks what can't be read."""
    t = F.regexp_replace(F.coalesce(x, F.lit("")), "[\\u00a0 ,.]", "")
    shape = "^-?[0-9]+$" if signed else "^[0-9]+$"
    return F.when(t == "", F.lit(0).cast("long")).when(t.rlike(shape), t.try_cast("long"))


def normalize_gender(x: Column, hint: str | None = None) -> Column:
    """by the whole mark, or by a stem of it, without regard to case and marks."""
    t = F.translate(F.lower(F.trim(x)), "ąćęłńóśźż", "acelnoszz")
    stem = lambda stems: F.exists(F.array(*map(F.lit, stems)), lambda s: F.contains(t, s))
    return F.coalesce(F.when(t.isin(*FEMALE) | stem(FEMALE_STEMS), "F").when(t.isin(*MALE) | stem(MALE_STEMS), "M"), F.lit(hint))


def classify_level(woj: Column, pow_: Column, gmi: Column, rodz: Column, kind: Column, commune_types: tuple[str, ...] = COMMUNE_TYPES) -> Column:
    """NULL for rows below a commune (to be skipped and counted)."""
    full = lambda c: F.coalesce(c, F.lit("")) != ""
    return (
        F.when(~full(pow_) & ~full(gmi) & ~full(rodz) & (kind == "województwo"), "voivodeship")
        .when(full(pow_) & ~full(gmi) & ~full(rodz) & kind.isin(*COUNTY_KINDS), "powiat")
        .when(full(pow_) & full(gmi) & rodz.isin(*commune_types) & kind.isin(*COMMUNE_KINDS), "gmina")
    )


def canonical_unit(name: Column, level: Column, kind: Column) -> Column:
    """struct(surface, policy); adjectival names are lower case."""
    adjectival = (level == "voivodeship") | ((level == "powiat") & (kind == "powiat"))
    return F.struct(F.when(adjectival, F.lower(F.trim(name))).otherwise(F.trim(name)).alias("surface"), F.when(adjectival, "lowercase").otherwise("capitalized").alias("policy"))


def unit_code(*parts: Column) -> Column:
    """F23"""
    return F.concat(*(F.coalesce(p, F.lit("")) for p in parts))


def casing_error(surface: Column, policy: Column) -> Column:
    """why a surface breaks its policy, else NULL."""
    return (
        F.when(F.coalesce(surface, F.lit("")) == "", "empty-surface")
        .when(~policy.isin("lowercase", "adjective", "capitalized") | policy.isNull(), "unknown-policy")
        .when(policy.isin("lowercase", "adjective") & (surface != F.lower(surface)), "not-lowercase")
        .when((policy == "capitalized") & ~surface.rlike(r"^\p{Lu}"), "not-capitalized")
    )


def parse_correction(line: Column) -> Column:
    """struct(wrong, canonical) of ``wrong -> canonical``."""
    p = F.split(F.trim(line), r"\s*->\s*")
    return F.when(F.size(p) == 2, F.struct(p[0].alias("wrong"), p[1].alias("canonical")))
