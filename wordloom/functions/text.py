"""Column functions over surfaces and words. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordloom.config import CASES, LexiconConfig

HYPHENS = "-‐‑"
_POSSESSIVE = r"(?iu)['’＇]s\b"
_TITLE = r"^\p{Lu}"


def components(x: Column, letters: str = r"\p{L}") -> Column:
    """runs of letters, after dropping an English possessive ending."""
    return F.regexp_extract_all(F.regexp_replace(x, _POSSESSIVE, ""), F.lit(f"([{letters}]+)"), 1)


def words(x: Column) -> Column:
    """Lower-cased runs of letters of a running text. A split by what isn't a letter takes half the time of extracting the runs."""
    return F.array_remove(F.split(F.lower(x), r"[^\p{L}]+"), "")


def component_records(x: Column) -> Column:
    """array of (idx from 1, word)."""
    return F.transform(components(x), lambda w, i: F.struct((i + 1).alias("idx"), w.alias("word")))


def is_multi_component(x: Column) -> Column:
    """F3"""
    return F.size(components(x)) > 1


def is_hyphenated(x: Column) -> Column:
    """a lexical hyphen between two or more non-empty parts; dashes don't count."""
    parts = F.filter(F.transform(F.split(x, f"[{HYPHENS}]"), F.trim), lambda p: p != "")
    return x.rlike(f"[{HYPHENS}]") & (F.size(parts) > 1)


def hyphenated_surfaces(x: Column) -> Column:
    """hyphenated ones among comma-separated alternatives, each once, in order."""
    return F.array_distinct(F.filter(F.transform(F.split(x, r"\s*,\s*"), F.trim), is_hyphenated))


def dictionary_surfaces(x: Column) -> Column:
    """components, then full hyphenated surfaces not among them."""
    return F.concat(components(x), F.array_except(hyphenated_surfaces(x), components(x)))


def fold(x: Column, cfg: LexiconConfig = LexiconConfig()) -> Column:
    """lower case without marks."""
    return F.translate(F.lower(x), cfg.marked, cfg.unmarked)


def normalized_header(name: str, cfg: LexiconConfig = LexiconConfig()) -> str:
    """F8: a header's comparison key; works on ``df.columns``, so on the driver."""
    return name.lower().translate(str.maketrans(cfg.marked, cfg.unmarked)).replace("_", "").replace(" ", "")


def upper_first(x: Column) -> Column:
    return F.concat(F.upper(F.substring(x, 1, 1)), x.substr(F.lit(2), F.length(x)))


def canonical_name(x: Column, letters: str = r"\p{L}") -> Column:
    """a single token in lower case with an upper first letter, else NULL."""
    t = F.trim(x)
    return F.when(t.rlike(f"^[{letters}]+(?:[{HYPHENS}'’][{letters}]+)*$"), upper_first(F.lower(t)))


def is_candidate(w: Column, cfg: LexiconConfig = LexiconConfig(), low: int | None = None, high: int | None = None) -> Column:
    """length and alphabet gate."""
    return F.length(w).between(low or cfg.min_length, high or cfg.max_length) & w.rlike(f"^[{cfg.alphabet}]+$")


def has_mark(w: Column, cfg: LexiconConfig = LexiconConfig()) -> Column:
    """F11"""
    return w.rlike(f"[{cfg.marked}]")


def is_ascii(w: Column) -> Column:
    """F12"""
    return ~w.rlike(r"[^\x00-\x7F]")


def is_inflection_surface(w: Column, letters: str = r"\p{L}") -> Column:
    """one token, or hyphen-joined parts that may hold blanks."""
    part = rf"[{letters}]+(?: [{letters}]+)*"
    return w.rlike(f"^[{letters}]+$") | w.rlike(f"^{part}(?:[{HYPHENS}]{part})+$")


def starts_upper(x: Column) -> Column:
    return x.rlike(_TITLE)


def starts_lower(x: Column) -> Column:
    return x.rlike(r"^\p{Ll}")


def case_policy(x: Column) -> Column:
    """F14"""
    return F.when(starts_upper(x), "capitalized").otherwise("lowercase")


def component_policy(component: Column, phrase_policy: Column) -> Column:
    """F14 for a component of a phrase."""
    return F.when((phrase_policy == "lowercase") | starts_lower(component), "lowercase").otherwise("capitalized")


def apply_policy(x: Column, policy: Column) -> Column:
    """F15"""
    return F.when(policy == "lowercase", F.lower(x)).when(policy == "capitalized", upper_first(x)).otherwise(x)


def preserve_initial(value: Column, source: Column) -> Column:
    """F16: the first letter's case of ``source``."""
    low = F.concat(F.lower(F.substring(value, 1, 1)), value.substr(F.lit(2), F.length(value)))
    return F.when(starts_upper(source), upper_first(value)).when(starts_lower(source), low).otherwise(value)


def _swapped(a: Column, b: Column) -> Column:
    """One swap of neighbours turns ``a`` into ``b``."""
    n = F.length(a)
    spots = F.when(n > 1, F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    turned = lambda i: F.concat(a.substr(F.lit(1), i - 1), a.substr(i + 1, F.lit(1)), a.substr(i, F.lit(1)), a.substr(i + 2, n))
    return F.exists(spots, lambda i: turned(i) == b)


def edit1_kind(a: Column, b: Column) -> Column:
    """how ``a`` differs from ``b`` by one edit, else NULL. A longer ``a`` is a deletion away."""
    d = F.levenshtein(a, b)
    return (
        F.when((d == 1) & (F.length(a) == F.length(b)), "substitution")
        .when((d == 1) & (F.length(a) > F.length(b)), "deletion")
        .when(d == 1, "insertion")
        .when((d == 2) & (F.length(a) == F.length(b)) & _swapped(a, b), "transposition")
    )


def single_deletes(w: Column) -> Column:
    """the word without one of its letters, each result once."""
    n = F.length(w)
    return F.when(n > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat(w.substr(F.lit(1), i - 1), w.substr(i + 1, n))))).otherwise(F.array().cast("array<string>"))


def surface_variants(key: Column) -> Column:
    """lower and upper-first probes."""
    return F.array_distinct(F.array(F.lower(key), upper_first(F.lower(key))))


def reason_class(r: Column) -> Column:
    """F27"""
    return F.split(F.split(r, "->")[0], ":")[0]


def zipf(count: Column, total: Column) -> Column:
    """log10 of occurrences per billion, rounded for comparison."""
    return F.round(F.log10(count * F.lit(1e9) / total), 6)


def tag_parts(tag: Column) -> Column:
    return F.split(tag, ":")


def tag_pos(tag: Column) -> Column:
    """part of speech."""
    return tag_parts(tag)[0]


def tag_number(tag: Column) -> Column:
    return F.when(F.size(tag_parts(tag)) > 1, F.get(tag_parts(tag), F.lit(1)))


def tag_cases(tag: Column) -> Column:
    """the cases of the third field, which joins several by dots."""
    return F.array_intersect(F.split(F.coalesce(F.get(tag_parts(tag), F.lit(2)), F.lit("")), r"\."), F.array(*map(F.lit, CASES)))


def is_singular_noun(tag: Column) -> Column:
    return (tag_pos(tag) == "subst") & (tag_number(tag) == "sg")


def is_sg_nom_noun(tag: Column, dotted: bool = False) -> Column:
    """whole fields by default, so that ``nom.acc`` doesn't count; ``dotted`` looks inside the field."""
    nominative = F.array_contains(tag_cases(tag), "nom") if dotted else F.array_contains(tag_parts(tag), "nom")
    return (tag_pos(tag) == "subst") & F.array_contains(tag_parts(tag), "sg") & nominative
