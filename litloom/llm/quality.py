"""Quality rules, line first: bad lines go, then documents that lose too much; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litloom.llm.runtime import WORD

SYMBOLS = "#*$%&|<>"
#: A document goes that keeps less than this share of its words.
KEEP_SHARE = 0.7
#: A prose line ends so, closing quotes and brackets aside, which is looked for in its last TAIL characters. A line of at
#: most SHORT words may also be a heading.
ENDS_WELL = r"""[.!?…:;,。！？]["'”’»)\]]*\s*$"""
SHORT, TAIL = 4, 40
#: White space as words are parted by, and SYMBOLS, as classes of characters.
SPACE, SYMBOL = r"[\x20\x09-\x0D]", f"[{SYMBOLS}]"
#: Menus, tables and link lists: items between separators.
NAVIGATION = r"(?:\s[|»›·•>]\s.*){2}|^\s*(?:[|»›·•>]\s)"
#: Stock phrases of licences, policies, menus and forms, as patterns for text in lower case.
PHRASES = (
    "all rights reserved", "terms (?:of|and) (?:use|service|conditions)", "privacy policy", "cookies?\\b.{0,40}\\b(?:policy|accept|use)", "accept (?:all )?cookies",
    "licensed under", "spdx-license-identifier", "javascript (?:is|must be)", "enable javascript", "lorem ipsum", "click here", "subscribe to", "sign (?:in|up) (?:to|for)", "copyright (?:©|\\(c\\)|\\d{4})",
    "released under the .{0,30}licen[cs]e", "tous droits réservés", "conditions (?:générales )?d.utilisation", "politique de confidentialité", "mentions légales", "cliquez ici", "abonnez-vous", "accepter (?:les )?cookies",
    "alle rechte vorbehalten", "nutzungsbedingungen", "datenschutzerklärung", "impressum\\b", "hier klicken", "jetzt abonnieren", "cookies akzeptieren",
    "todos los derechos reservados", "términos (?:y condiciones|de uso)", "política de privacidad", "haga clic aquí", "suscríbete", "aceptar (?:las )?cookies",
)


def _phrases(phrases: tuple[str, ...]) -> str:
    """One pattern for all, whose first letters are tried once."""
    by_letter: dict[str, list[str]] = {}
    for p in phrases:
        by_letter.setdefault(p[0], []).append(p[1:])
    return r"\b(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by_letter.items()) + ")"


BOILERPLATE = _phrases(PHRASES)


def _let(value: Column, body) -> Column:
    """body of a column that is worked out once for each row, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column) -> Column:
    """How many words lie in a window of three consecutive words that the array has twice or more.

    Windows are compared by a 64-bit hash of their words' hashes, within one text only.
    """
    def covered(at: Column) -> Column:
        """Words covered by windows that start at these sorted places."""
        steps = F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def places(pairs: Column) -> Column:
        twice = F.filter(pairs, lambda p, i: (p["h"] == F.get(pairs, i + 1)["h"]) | ((i > 0) & (p["h"] == F.get(pairs, F.greatest(i - 1, F.lit(0)))["h"])))
        return F.array_sort(F.transform(twice, lambda p: p["i"]))

    def of(ws: Column) -> Column:
        one = F.transform(ws, lambda w: F.xxhash64(w))
        hashes = _let(one, lambda hs: F.transform(F.slice(hs, 1, F.size(hs) - 2), lambda h, i: F.xxhash64(h, F.get(hs, i + 1), F.get(hs, i + 2))))
        many = lambda hs: _let(F.array_sort(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), lambda pairs: _let(places(pairs), covered))
        return F.when(F.size(ws) < 4, F.lit(0).cast("long")).otherwise(_let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")).otherwise(many(hs))))

    return _let(words, of)


def line_rules(lines: Column) -> Column:
    """Each line that has a word: its text, words, and whether it fails a rule.

    punctuation: it doesn't end as prose does, and is no short heading. navigation: items between separators.
    boilerplate: one of PHRASES. shouting: 20 letters or more, in upper case. symbols: at least one of SYMBOLS for
    every four words. repeated: half of the words, in a line of ten or more, are the same as the one before.
    """
    def rules(line: Column) -> Column:
        return _let(F.regexp_extract_all(line, F.lit(WORD), F.lit(0)), lambda words: judged(line, words))

    def judged(line: Column, words: Column) -> Column:
        n = F.size(words)
        # Like neighbours leave few distinct words, which are counted faster.
        few = F.size(F.array_distinct(words)) * 2 <= n + 1
        return F.struct(
            line.alias("line"),
            n.cast("long").alias("n"),
            ((n > SHORT) & ~F.substring(line, -TAIL, TAIL).rlike(ENDS_WELL)).alias("punctuation"),
            line.rlike(NAVIGATION).alias("navigation"),
            F.lower(line).rlike(BOILERPLATE).alias("boilerplate"),
            ((line == F.upper(line)) & (line != F.lower(line)) & (F.char_length(F.regexp_replace(line, r"[^\p{L}]", "")) >= 20)).alias("shouting"),
            (F.regexp_count(line, F.lit(SYMBOL)) * 4 >= n).alias("symbols"),
            ((n >= 10) & few & (F.size(F.filter(words, lambda w, i: w == F.get(words, i - 1))) * 2 >= n)).alias("repeated"),
        )

    return F.filter(F.transform(lines, rules), lambda x: x["n"] > 0)


def clean_documents(docs: DataFrame, keep_share: float = KEEP_SHARE) -> DataFrame:
    """For each document the base counts, its lines' failures, the text left, and whether it is kept.

    Null and empty texts have no words and so fail the base; a text without a line break is one line.
    Lines fail by line_rules; clean_text is what is left, null for a null text. A document is kept that passes
    the base and keeps at least keep_share of its words. Every row is judged by itself, whatever its doc_id.
    """
    words = F.coalesce(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", "text").select(
        "doc_id",
        "text",
        F.size(words).cast("long").alias("n_words"),
        (F.char_length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        repeat_words(words).alias("n_repeat_words"),
        line_rules(F.split(text, "\n", -1)).alias("lines"),
    )
    bad = lambda x: x["punctuation"] | x["navigation"] | x["boilerplate"] | x["shouting"] | x["symbols"] | x["repeated"]
    failed = lambda rule: F.size(F.filter("lines", lambda x: x[rule])).cast("long").alias(f"n_{rule}_lines")
    good = F.filter("lines", lambda x: ~bad(x))
    judged = base.select(
        "doc_id", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct(F.transform("lines", lambda x: x["line"])))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        *(failed(r) for r in ("punctuation", "navigation", "boilerplate", "shouting", "symbols", "repeated")),
        F.aggregate(good, F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n_left"),
        F.when(F.col("text").isNotNull(), F.array_join(F.transform(good, lambda x: x["line"]), "\n")).alias("clean_text"),
    )
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.withColumn("base_failed", base_failed).withColumn("kept", ~F.col("base_failed") & (F.col("n_left") >= keep_share * F.col("n_words")))


def quality_digest(docs: DataFrame) -> DataFrame:
    return clean_documents(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_left")
