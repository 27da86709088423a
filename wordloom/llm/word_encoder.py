"""Token ids of whole texts, each distinct stretch of text encoded once by its own library.

A text is cut only where the tokenizer's own rules let no token cross, so the ids of the stretches joined are the ids of the whole text. A worker keeps
the ids of the stretches it has met, up to ``KEPT`` of them; texts that the cut can't be shown safe for go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np

#: Stretches held by a worker, and the longest one held (code points).
KEPT, LONGEST = 600_000, 48
#: Stretches in one call of a library.
AT_ONCE = 20_000
#: Characters that Python takes for white space and the tokenizers don't.
_UNSURE = re.compile("[\x1c-\x1f]")
#: A splitter that keeps no white space, and the steps allowed before it.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: What stands outside letters and signs that lower-casing and composing treat one by one; and the splitter's pieces of a lower-cased text within them.
_BEYOND = re.compile("[^\t\n\r -~\u00a1-\u00a9\u00ab-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf-\u012f\u0131-\u017f\u2010-\u2027\u20ac]")
_PIECE = re.compile("[a-z\u00df-\u00f6\u00f8-\u017f]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|\n|[^\\sa-z0-9\u00df-\u00f6\u00f8-\u017f]+")
_SAFE_STEPS = ({"type": "NFC"}, {"type": "Lowercase"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "})


class StretchCache:
    """Packed ids of stretches of text; ``encode`` is the library's call for a list of texts.

    Two generations: when the young one is full it becomes the old one, so what is met again and again stays.
    """

    def __init__(self, encode: Callable[[list[str]], list], width: int):
        self.encode, self.kind, self.young, self.old = encode, f"<u{width}", {}, {}

    def packed(self, texts: list[list[str]]) -> list[bytes]:
        """The ids of each text, given as its stretches."""
        met = set().union(*texts)
        need = met.difference(self.young)
        known = list(filter(self.old.__contains__, need))
        found = self.young
        found.update(zip(known, map(self.old.__getitem__, known)))
        new, once = list(need.difference(known)), {}
        for at in range(0, len(new), AT_ONCE):
            part = new[at : at + AT_ONCE]
            for stretch, ids in zip(part, self.encode(part)):
                (found if len(stretch) <= LONGEST else once)[stretch] = ids if isinstance(ids, bytes) else np.asarray(ids, dtype=self.kind).tobytes()
        every = {**found, **once} if once else found
        out = [b"".join(map(every.__getitem__, stretches)) for stretches in texts]
        if len(found) > KEPT // 2:
            self.young, self.old = {}, found
        return out


class WordEncoder:
    """Ids by a ``tokenizers`` file, packed in ``width`` bytes each.

    Where the file's splitter keeps no white space, texts are cut at white space. The words of a text of Latin letters and common signs are lower-cased
    first, and new ones among them are cut into the splitter's own pieces, of which many go to the library in one call.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        vocabulary = self.tok.get_vocab()
        self.width = 2 if max(vocabulary.values()) < (1 << 16) - 1 else 4
        self.stretches = self.pieces = self.words = None
        if self._drops_space(spec):
            self.stretches = StretchCache(self._ids, self.width)
        ending = (spec["model"].get("end_of_word_suffix") or "") if spec["model"].get("type") == "BPE" else ""
        if self.stretches and ending and {"type": "Lowercase"} in spec["normalizer"].get("normalizers", []):
            self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.ends[[i for w, i in vocabulary.items() if w.endswith(ending)]] = True
            self.pieces = StretchCache(self._piece_ids, self.width)
            self.words = StretchCache(self._word_ids, self.width)

    @staticmethod
    def _drops_space(spec: dict) -> bool:
        steps = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
        steps = steps["normalizers"] if steps["type"] == "Sequence" else [steps]
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        split, rest = cuts[0], cuts[1:]
        kept_out = split.get("type") == "Split" and split.get("pattern") == {"Regex": WORD_SPLIT} and split.get("behavior") == "Removed" and split.get("invert")
        plain = all(c.get("type") == "ByteLevel" and not c.get("add_prefix_space") and not c.get("use_regex", True) for c in rest)
        return bool(kept_out) and plain and all(s in _SAFE_STEPS for s in steps) and spec.get("post_processor") is None and all(t.get("special") for t in spec.get("added_tokens") or ())

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _piece_ids(self, pieces: list[str]) -> list:
        """One call for many pieces: each is one word of the model, whose last id carries the end mark."""
        ids = np.asarray(self._ids([" ".join(pieces)])[0], dtype=self.pieces.kind)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(pieces):
            return self._ids(pieces)
        return self._cut(ids.tobytes(), stops.tolist(), 0)

    def _cut(self, packed: bytes, stops: list[int], skip: int) -> list[bytes]:
        """The ids up to each of ``stops``, without ``skip`` ids after each."""
        w = self.width
        return [packed[lo * w : hi * w] for lo, hi in zip([0, *(x + skip for x in stops)], stops)]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """All words at once: they are cut as one text, in which a line end of its own id parts them."""
        mark = b"\xff" * self.width
        flat = _PIECE.findall("\n".join(words))
        self.pieces.young["\n"] = mark
        ids = self.pieces.packed([flat])[0]
        whole = np.frombuffer(ids, dtype=self.pieces.kind)
        return self._cut(ids, [*np.flatnonzero(whole == (1 << 8 * self.width) - 1).tolist(), len(whole)], 1)

    def packed(self, texts: list[str]) -> list[bytes]:
        if self.stretches is None:
            return [np.asarray(x, dtype=f"<u{self.width}").tobytes() for x in self._ids(texts)]
        latin = [self.words is not None and not _BEYOND.search(t) for t in texts]
        out: list[bytes] = [b""] * len(texts)
        for cache, chosen, cut in ((self.words, True, lambda t: t.lower().split()), (self.stretches, False, lambda t: [t] if _UNSURE.search(t) else t.split())):
            at = [i for i, x in enumerate(latin) if x == chosen]
            if at:
                for i, ids in zip(at, cache.packed([cut(texts[i]) for i in at])):
                    out[i] = ids
        return out


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker, which serves many tasks."""
    return WordEncoder(path)
