"""Secret scans: patterns of labelled credentials, and automata of their formats, inferred by merging prefix-tree states.

What the patterns find are labelled credentials. Of each kind, and of ordinary strings, a bounded sample of distinct values
(those of smallest hash over all texts) gives a prefix tree of character classes; states whose frequencies agree within
Hoeffding's bound are merged, which leaves a probabilistic automaton. Every candidate string of every text is scored by how
much likelier a kind's automaton makes it than that of ordinary strings.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import blake2b
from math import exp, inf, log, sqrt

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litloom.llm.runtime import as_scan, forget, ship, staged, with_row_key

KINDS = ("assign", "access", "hex")
ORDINARY = "ordinary"
#: The name of what is assigned; letters in either case.
_NAME = "(?:" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
PATTERNS = {
    "assign": _NAME + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"(AKIA[A-Z0-9]{12,})",
    "hex": r"([0-9a-f]{32,})",
}
_FIND = {k: re.compile(p) for k, p in PATTERNS.items()}
LEAST_ASSIGNED = 8
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")

#: Distinct values of each kind, and of ordinary strings, that automata are inferred from and cuts are chosen on.
FIT_LIMIT = 4_000
#: Longer values aren't inferred from; they are scored like others.
FIT_LENGTH = 256
#: Confidence of Hoeffding's bound for the merging of states.
ALPHA = 0.05
#: One value in so many is left out of inference, to see whether a kind knows its own.
HELD_OUT = 4
#: Least score, a natural log: over 7 times as likely under the kind's format. As unlabelled credentials are among ordinary
#: strings, those of a format that makes up a share c of them score log(1 / c), so one of up to 13 % is still told apart.
LEAST_SCORE = 2.0

#: Classes of characters; each other character of a candidate is a class of its own.
CLASSES = {"0": "0123456789", "f": "abcdef", "z": "ghijklmnopqrstuvwxyz", "F": "ABCDEF", "Z": "GHIJKLMNOPQRSTUVWXYZ"}
_CLASS_OF = str.maketrans({c: k for k, chars in CLASSES.items() for c in chars})
END = ""
SYMBOLS = (*CLASSES, *"+/_.=-", END)

SPANS = "array<struct<start: int, kind: int, end: int, base: boolean, score: double>>"


def base_spans(text: str, kinds: Iterable[str] = KINDS) -> list[tuple[int, int, int, str]]:
    """(start, number of the kind, end, value) of what the patterns find in code points, in order. An assigned value of
    fewer than LEAST_ASSIGNED characters is passed over, and so is what it stands in."""
    out = [(m.start(), k, m.end(), m[1]) for k, kind in enumerate(KINDS) if kind in kinds for m in _FIND[kind].finditer(text)]
    return sorted(s for s in out if s[1] or len(s[3]) >= LEAST_ASSIGNED)


def other_candidates(text: str, base: list[tuple[int, int, int, str]]) -> Iterator[re.Match]:
    """The candidates of text that share no character with a base span."""
    spans, i = base, 0
    for m in CANDIDATE.finditer(text):
        while i < len(spans) and spans[i][0] < m.start() and max(s[2] for s in spans[max(0, i - len(KINDS)) : i + 1]) <= m.start():
            i += 1
        if not any(s[0] < m.end() and m.start() < s[2] for s in spans[max(0, i - len(KINDS)) :]):
            yield m


class _State:
    __slots__ = ("counts", "next")

    def __init__(self):
        self.counts: Counter[str] = Counter()
        self.next: dict[str, _State] = {}


def _prefix_tree(words: Iterable[str]) -> _State:
    root = _State()
    for word in words:
        at = root
        for symbol in word:
            at.counts[symbol] += 1
            at = at.next.setdefault(symbol, _State())
        at.counts[END] += 1
    return root


def _compatible(a: _State, b: _State, width: float) -> bool:
    """Whether the shares of every symbol, and of those in what follows, differ by less than Hoeffding's bound."""
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        n, m = x.counts.total(), y.counts.total()
        if not n or not m:
            continue
        bound = width * (1 / sqrt(n) + 1 / sqrt(m))
        if bound >= 1:
            continue
        if any(abs(x.counts[s] / n - y.counts[s] / m) > bound for s in x.counts.keys() | y.counts.keys()):
            return False
        todo.extend((x.next[s], y.next[s]) for s in x.next.keys() & y.next.keys())
    return True


def _fold(into: _State, tree: _State) -> list[tuple[_State, str]]:
    """Adds a tree's counts to the states that its paths lead to from `into`; returns the edges by which parts are hung on."""
    todo, hung = [(into, tree)], []
    while todo:
        a, b = todo.pop()
        a.counts.update(b.counts)
        for symbol, state in b.next.items():
            if symbol in a.next:
                todo.append((a.next[symbol], state))
            else:
                a.next[symbol] = state
                hung.append((a, symbol))
    return hung


def infer(words: Iterable[str], alpha: float = ALPHA) -> list[tuple[dict[str, float], dict[str, int]]]:
    """A probabilistic automaton of words over SYMBOLS: for each state its symbols' log probabilities and next states.

    States of the prefix tree are taken by how many words pass through; one that is compatible with a state taken before
    is merged into it, and its tree is folded. State 0 is the start. What no word did has no share.
    """
    width = sqrt(0.5 * log(2 / alpha))
    root = _prefix_tree(words)
    taken, edges = [root], [(root, s) for s in sorted(root.next)]
    while edges:
        i = max(range(len(edges)), key=lambda i: edges[i][0].counts[edges[i][1]])
        parent, symbol = edges.pop(i)
        state = parent.next[symbol]
        if any(state is t for t in taken):
            continue
        for t in taken:
            if _compatible(t, state, width):
                parent.next[symbol] = t
                edges.extend((a, s) for a, s in _fold(t, state) if any(a is x for x in taken))
                break
        else:
            taken.append(state)
            edges.extend((state, s) for s in sorted(state.next))
    number = {id(t): i for i, t in enumerate(taken)}
    out = []
    for t in taken:
        total = t.counts.total()
        out.append(({s: log(n / total) for s, n in t.counts.items()}, {s: number[id(x)] for s, x in t.next.items()}))
    return out


def log_likelihood(automaton: list[tuple[dict[str, float], dict[str, int]]], word: str) -> float:
    """Natural log of the probability of word, a string of classes, and its end; minus infinity off the automaton's paths."""
    at, total = 0, 0.0
    for symbol in word:
        shares, follow = automaton[at]
        if symbol not in follow:
            return -inf
        total += shares[symbol]
        at = follow[symbol]
    return total + automaton[at][0].get(END, -inf)


def classes(value: str) -> str:
    return value.translate(_CLASS_OF)


def _value_hash(value: str) -> int:
    return int.from_bytes(blake2b(value.encode(), digest_size=8).digest(), "big") >> 1


class Formats:
    """The automata of ordinary strings and of the kinds that have labelled values enough.

    labelled: (kind or ORDINARY, value). Every HELD_OUT-th value by hash is left out of inference; a kind is left out if
    under half of its own of these score LEAST_SCORE.
    """

    def __init__(self, labelled: Iterable[tuple[str, str]], least: int = 20):
        fitted: dict[str, list[str]] = {k: [] for k in (*KINDS, ORDINARY)}
        held: dict[str, list[str]] = {k: [] for k in (*KINDS, ORDINARY)}
        for kind, value in sorted(set(labelled)):
            (held if _value_hash(value) % HELD_OUT == 0 else fitted)[kind].append(classes(value))
        self.ordinary = infer(fitted[ORDINARY])
        self.automata = {}
        for k, kind in enumerate(KINDS):
            if len(fitted[kind]) < least:
                continue
            automaton = infer(fitted[kind])
            if 2 * sum(log_likelihood(automaton, w) - self._against(w) > LEAST_SCORE for w in held[kind]) > len(held[kind]):
                self.automata[k] = automaton

    def _against(self, word: str) -> float:
        """Log likelihood of an ordinary string: half the automaton's, half even over all symbols."""
        even, own = -(len(word) + 1) * log(len(SYMBOLS)), log_likelihood(self.ordinary, word)
        return max(even, own) + log(1 + exp(-abs(even - own))) - log(2)

    def score(self, value: str) -> tuple[int, float] | None:
        """The kind that makes value likelier by the most, and by how much (log); None below LEAST_SCORE."""
        if not self.automata:
            return None
        word = classes(value)
        score, k = max((log_likelihood(a, word), -k) for k, a in self.automata.items())
        if score == -inf:
            return None
        score -= self._against(word)
        return (-k, score) if score > LEAST_SCORE else None


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, list[tuple[int, int, int, str]]]]:
    """Each text (null: empty) and its base spans; RE2 tells which patterns a text is searched for."""
    has = [pc.fill_null(pc.match_substring_regex(batch["text"], PATTERNS[k].replace("{12,}", "{12}").replace("{32,}", "{32}")), False).to_pylist() for k in KINDS]
    for i, text in enumerate(batch["text"].to_pylist()):
        kinds = [k for k, h in zip(KINDS, has, strict=True) if h[i]]
        yield text or "", base_spans(text, kinds) if kinds else []


def labelled_values(texts: DataFrame, limit: int = FIT_LIMIT) -> list[tuple[str, str]]:
    """(kind or ORDINARY, value): of each label the `limit` distinct values of smallest hash in all texts, up to FIT_LENGTH.

    A task sends its `limit` smallest of each label; those of all tasks are cut to the limit where they meet.
    """

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, dict[str, int]] = {k: {} for k in (*KINDS, ORDINARY)}
        seen: set[str] = set()
        most = dict.fromkeys(kept, 2**63)

        def cut(label: str) -> None:
            order = sorted(kept[label].items(), key=lambda x: (x[1], x[0]))
            kept[label] = dict(order[:limit])
            if len(order) > limit:
                most[label] = order[limit][1]

        def add(label: str, value: str) -> None:
            if len(value) <= FIT_LENGTH and (h := _value_hash(value)) <= most[label]:
                kept[label][value] = h
                if len(kept[label]) > 4 * limit:
                    cut(label)

        for batch in batches:
            for text, base in _texts(batch):
                for _, k, _, value in base:
                    add(KINDS[k], value)
                found = {m.group() for m in other_candidates(text, base)} if base else set(CANDIDATE.findall(text))
                for value in found - seen:
                    add(ORDINARY, value)
                seen |= found
                if len(seen) > 200_000:
                    seen = set()
        for label in kept:
            cut(label)
        rows = [(label, h, value) for label, values in kept.items() for value, h in values.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())], ["label", "h", "value"])

    found = staged(texts.select("text").mapInArrow(smallest, "label string, h long, value string"), "values")
    out = [(r.label, r.value) for label in (*KINDS, ORDINARY) for r in found.filter(F.col("label") == label).distinct().orderBy("h", "value").limit(limit).collect()]
    forget(found)
    return out


def secret_spans(docs: DataFrame, formats: Formats | None = None) -> DataFrame:
    """rid, did, doc_id, spans of each row: start, kind (its place in KINDS), end in code points, base, score.

    Base spans, which the patterns find, have no score. Any other maximal run of 8 or more of the characters that values
    are made of is a candidate; those that touch no base span and score LEAST_SCORE are spans too. Formats are inferred
    from docs where none are given. Spans are ordered by start, then kind. A null text is an empty one and has none; a
    repeated row or id is a row of its own; other columns are ignored; an empty table has no rows.
    """
    docs = as_scan(docs)
    ship(docs.sparkSession)
    if formats is None:
        formats = Formats(labelled_values(docs))

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = lru_cache(1 << 17)(formats.score)
        struct = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())])
        for batch in batches:
            out = []
            for text, base in _texts(batch):
                found = [(s, k, e, True, None) for s, k, e, _ in base]
                if formats.automata:
                    found += [(m.start(), hit[0], m.end(), False, hit[1]) for m in other_candidates(text, base) if (hit := score(m.group()) if m.end() - m.start() <= FIT_LENGTH else formats.score(m.group()))]
                out.append([dict(zip(("start", "kind", "end", "base", "score"), s, strict=True)) for s in sorted(found, key=lambda s: s[:2])])
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("doc_id", "rid", "did")), pa.array(out, pa.list_(struct))], ["doc_id", "rid", "did", "spans"])

    return with_row_key(docs, F.col("doc_id").cast("long").alias("doc_id"), "text").select("doc_id", "rid", "did", "text").mapInArrow(spans, f"doc_id long, rid long, did long, spans {SPANS}").select("rid", "did", "doc_id", "spans")


def secrets_digest(docs: DataFrame) -> DataFrame:
    """Counts of the base spans by kind, the digest of their places, and all spans' places."""
    name = F.array(*map(F.lit, KINDS))
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])

    def of_kind(k: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    return secret_spans(docs).select("doc_id", *map(of_kind, range(len(KINDS))), F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))
