"""Labels and terms to keys: tokens, stop words, stems, transliteration. Columns in, columns out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: English stop words.
STOP_WORDS = (
    "a i about above after again against all am an and any are aren't as at be because been before being below between both "
    "but by can't cannot could couldn't did didn't do does doesn't doing don't down during each few for from further had hadn't "
    "has hasn't have haven't having he he'd he'll he's her here here's hers herself him himself his how how's i'd i'll i'm i've "
    "if in into is isn't it it's its itself let's me more most mustn't my myself no nor not of off on once only or other ought "
    "our ours ourselves out over own same shan't she she'd she'll she's should shouldn't so some such than that that's the their "
    "theirs them themselves then there there's these they they'd they'll they're they've this those through to too under until "
    "up very was wasn't we we'd we'll we're we've were weren't what what's when when's where where's which while who who's whom "
    "why why's with won't would wouldn't you you'd you'll you're you've your yours yourself yourselves"
).split()
#: Compared as they stand: a word, or the word with a capital first letter, but for single letters.
STOPPED = tuple(dict.fromkeys([*STOP_WORDS, *(w[0].upper() + w[1:] for w in STOP_WORDS if len(w) > 1)]))

#: Greek small letters and what they are written as.
GREEK, LATIN = "αβγδεζηικλμνξπτυω", "abgdezhiklmnxptuo"


def transliterate(c: Column) -> Column:
    """Greek small letters as Latin ones; other letters stay."""
    return F.translate(c, GREEK, LATIN)


def _cleaned(tokens: Column) -> Column:
    """Tokens in lower case with word characters only; empty ones go."""
    return F.filter(F.transform(tokens, lambda t: F.lower(F.regexp_replace(t, r"[^\w\s]", ""))), lambda t: t != "")


def symbol_tokens(c: Column) -> Column:
    """Tokens for exact symbols: cut at white space, colon, comma and semicolon, so a hyphen stays within."""
    return _cleaned(F.split(c, r"[\s:,;]+"))


def word_tokens(c: Column) -> Column:
    """Tokens for prose: cut at hyphens and slashes too, without stop words, which are compared before lower-casing."""
    return _cleaned(F.filter(F.split(c, r"[\s\-/:,;]+"), lambda t: ~t.isin(*STOPPED)))


def symbol_key(tokens: Column) -> Column:
    """Tokens in their order, with repeats, in one string; null where that is empty."""
    return F.nullif(F.array_join(tokens, ""), F.lit(""))


def word_key(tokens: Column) -> Column:
    """Distinct tokens in sorted order in one string, whatever their order; null where that is empty."""
    return symbol_key(F.array_sort(F.array_distinct(tokens)))
