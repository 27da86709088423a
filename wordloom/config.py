"""Language data and thresholds as configuration."""

from __future__ import annotations

from dataclasses import dataclass, field

# Alphabet, marks, cases and rival languages of the default profile.
ALPHABET = "aąbcćdeęfghijklłmnńoóprsśtuwyzźż"
MARKED, UNMARKED = "ąćęłńóśźż", "acelnoszz"
CASES = ("nom", "gen", "dat", "acc", "inst", "loc", "voc")
RIVALS = ("en", "de", "fr", "es", "it", "pt", "nl", "sv", "cs", "sk", "ru")


@dataclass(frozen=True)
class LexiconConfig:
    """Everything that differs between languages; operators take one of these."""

    language: str = "pl"
    alphabet: str = ALPHABET
    marked: str = MARKED
    unmarked: str = UNMARKED
    min_length: int = 1
    max_length: int = 25
    rivals: tuple[str, ...] = RIVALS
    own_cap: float = 3.5
    rival_floor: float = 3.0
    rival_lead: float = 1.0
    known_zipf: float = 3.5
    known_ranks: int = 5000
    common_zipf: float = 4.0
    #: (longest length, least gap) in order; the last one is for all longer words.
    typo_gaps: tuple[tuple[int, float], ...] = ((3, 3.0), (5, 2.5), (10_000, 2.0))
    guards: tuple[str, ...] = field(default=())


#: Western European text: letters with marks of French, German and Spanish.
WESTERN = LexiconConfig(
    language="fr",
    alphabet="abcdefghijklmnopqrstuvwxyzàâäáãçéèêëíìîïñóòôöõúùûüÿßœæ",
    marked="àâäáãçéèêëíìîïñóòôöõúùûüÿ",
    unmarked="aaaaaceeeeiiiinooooouuuuy",
    rivals=("en", "de", "es"),
)
