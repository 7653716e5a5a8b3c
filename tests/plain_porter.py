"""Porter's algorithm word by word, for tests to hold the library's columns against."""

import re
from functools import lru_cache


def _consonant(w: str, i: int) -> bool:
    return w[i] not in "aeiou" and not (w[i] == "y" and i and _consonant(w, i - 1))


def _measure(w: str) -> int:
    """How often a vowel is followed by a consonant."""
    kinds = [_consonant(w, i) for i in range(len(w))]
    return sum(b and not a for a, b in zip(kinds, kinds[1:], strict=False))


def _vowel(w: str) -> bool:
    return any(not _consonant(w, i) for i in range(len(w)))


def _cvc(w: str) -> bool:
    return len(w) > 2 and _consonant(w, len(w) - 3) and not _consonant(w, len(w) - 2) and _consonant(w, len(w) - 1) and w[-1] not in "wxy"


def _doubled(w: str) -> bool:
    return len(w) > 1 and w[-1] == w[-2] and _consonant(w, len(w) - 1)


#: The suffix lists of steps 2, 3 and 4 of Porter (1980).
_STEP_2 = [x.split(":") for x in "ational:ate tional:tion enci:ence anci:ance izer:ize abli:able alli:al entli:ent eli:e ousli:ous ization:ize ation:ate ator:ate alism:al iveness:ive fulness:ful ousness:ous aliti:al iviti:ive biliti:ble".split()]
_STEP_3 = [x.split(":") for x in "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:".split()]
_STEP_4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()


@lru_cache(maxsize=1 << 16)
def porter_stem(w: str) -> str:
    """The stem of a lower-case word by Porter's algorithm (1980); short and non-ASCII words stay."""
    if len(w) < 3 or not re.fullmatch(r"[a-z]+", w):
        return w
    if w.endswith("s"):
        w = w[:-2] if w.endswith(("sses", "ies")) else w if w.endswith("ss") else w[:-1]
    if w.endswith("eed"):
        w = w[:-1] if _measure(w[:-3]) else w
    else:
        for suffix in ("ed", "ing"):
            if w.endswith(suffix):
                if _vowel(stem := w[: -len(suffix)]):
                    w = stem
                    if w.endswith(("at", "bl", "iz")):
                        w += "e"
                    elif _doubled(w) and w[-1] not in "lsz":
                        w = w[:-1]
                    elif _measure(w) == 1 and _cvc(w):
                        w += "e"
                break
    if w.endswith("y") and _vowel(w[:-1]):
        w = w[:-1] + "i"
    for rules in (_STEP_2, _STEP_3):
        found = max((r for r in rules if w.endswith(r[0])), key=lambda r: len(r[0]), default=None)
        if found and _measure(w[: -len(found[0])]) > 0:
            w = w[: -len(found[0])] + found[1]
    if found4 := max((s for s in _STEP_4 if w.endswith(s)), key=len, default=None):
        stem = w[: -len(found4)]
        if _measure(stem) > 1 and (found4 != "ion" or stem[-1:] in ("s", "t")):
            w = stem
    if w.endswith("e") and (_measure(w[:-1]) > 1 or (_measure(w[:-1]) == 1 and not _cvc(w[:-1]))):
        w = w[:-1]
    return w[:-1] if _doubled(w) and w[-1] == "l" and _measure(w) > 1 else w
