"""Porter's algorithm as DuckDB SQL, for the counterparts of stemmed queries: one regular expression for each test."""

from __future__ import annotations

from litloom.functions.porter import FOURTH as _FOURTH
from litloom.functions.porter import MORE as _MORE
from litloom.functions.porter import ONE as _ONE
from litloom.functions.porter import SECOND as _SECOND
from litloom.functions.porter import SHORT as _SHORT
from litloom.functions.porter import SOME as _SOME
from litloom.functions.porter import THIRD as _THIRD
from litloom.functions.porter import WITH_VOWEL as _VOWEL


def _is(c: str, pattern: str) -> str:
    return f"regexp_matches({c}, '{pattern}')"


def _replaced(rules: str) -> str:
    """The longest suffix that a word ends in, if what is left of the word has a measure."""
    pairs = sorted((r.split(" ") for r in rules.split(",")), key=lambda r: -len(r[0]))
    cases = " ".join(f"WHEN suffix(w, '{a}') THEN CASE WHEN {_is(f'left(w, -{len(a)})', _SOME)} THEN left(w, -{len(a)}) || '{b}' ELSE w END" for a, b in pairs)
    return f"CASE {cases} ELSE w END"


def _dropped(suffixes: str) -> str:
    cases = []
    for a in sorted(suffixes.split(), key=lambda a: -len(a)):
        stem = f"left(w, -{len(a)})"
        cases.append(f"WHEN suffix(w, '{a}') THEN CASE WHEN {_is(stem, _MORE)}" + (f" AND right({stem}, 1) IN ('s', 't')" if a == "ion" else "") + f" THEN {stem} ELSE w END")
    return f"CASE {' '.join(cases)} ELSE w END"


def stems_sql(words: str) -> str:
    """Clauses of a WITH, the last of which, stems, has (t, stem) for each token t of the clause `words`."""
    cut = f"NOT suffix(w, 'eed') AND (suffix(w, 'ed') AND {_is('left(w, -2)', _VOWEL)} OR suffix(w, 'ing') AND {_is('left(w, -3)', _VOWEL)})"
    steps = [
        "CASE WHEN suffix(w, 'sses') OR suffix(w, 'ies') THEN left(w, -2) WHEN suffix(w, 'ss') THEN w WHEN suffix(w, 's') THEN left(w, -1) ELSE w END AS w",
        f"CASE WHEN suffix(w, 'eed') THEN CASE WHEN {_is('left(w, -3)', _SOME)} THEN left(w, -1) ELSE w END WHEN {cut} THEN left(w, CASE WHEN suffix(w, 'ed') THEN -2 ELSE -3 END) ELSE w END AS w, {cut} AS c",
        f"CASE WHEN c AND right(w, 2) IN ('at', 'bl', 'iz') THEN w || 'e' WHEN c AND right(w, 1) = left(right(w, 2), 1) AND length(w) > 1 AND NOT contains('aeioulsz', right(w, 1)) THEN left(w, -1) "
        f"WHEN c AND {_is('w', _ONE)} AND {_is('w', _SHORT)} THEN w || 'e' ELSE w END AS w",
        f"CASE WHEN suffix(w, 'y') AND {_is('left(w, -1)', _VOWEL)} THEN left(w, -1) || 'i' ELSE w END AS w",
        f"{_replaced(_SECOND)} AS w",
        f"{_replaced(_THIRD)} AS w",
        f"{_dropped(_FOURTH)} AS w",
        f"CASE WHEN suffix(w, 'e') AND ({_is('left(w, -1)', _MORE)} OR {_is('left(w, -1)', _ONE)} AND NOT {_is('left(w, -1)', _SHORT)}) THEN left(w, -1) ELSE w END AS w",
        f"CASE WHEN suffix(w, 'll') AND {_is('w', _MORE)} THEN left(w, -1) ELSE w END AS w",
    ]
    clauses = [f"st0 AS (SELECT t, CASE WHEN prefix(t, 'y') THEN 'Y' || t[2:] ELSE t END AS w FROM {words} WHERE regexp_full_match(t, '[a-z]{{3,}}'))"]
    clauses += [f"st{i + 1} AS (SELECT t, {step} FROM st{i})" for i, step in enumerate(steps)]
    return ",\n".join([*clauses, f"stems AS (SELECT t, coalesce(lower(w), t) AS stem FROM {words} LEFT JOIN st{len(steps)} USING (t))"])
