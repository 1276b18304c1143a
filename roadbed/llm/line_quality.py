"""Quality rules, lines first: bad lines go, then texts that lost too much.

Every line of a text is held against punctuation, navigation and boilerplate
rules; lines that fail any are removed. A text is rejected if the words of the
removed lines are too large a share of its words, or if it fails one of two rules
on the whole text (few words, many repeated ones). All of it is DataFrame
functions on one row at a time: no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What parts words, and what counts as a symbol.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[ \t-\r]+"
SYMBOLS = "#*$%&|<>"

# Whole-text rules.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
WINDOW = 3

#: marks that prose holds few of; a line of many is decoration, code or shouting
MARKS = SYMBOLS + "!=+~^_{}[]\\/@"
MAX_MARKS_PERCENT, MIN_MARKS = 10, 3
#: what parts the items of a menu; a line of short items is navigation
SEPARATORS = "|»›•·→"
MIN_SEPARATORS, WORDS_PER_ITEM = 3, 4
#: a share of words above which a text that lost them is rejected
MAX_LOST_PERCENT = 50

#: whole lines (lower-cased, without what parts words at the ends) that lead elsewhere
NAVIGATION = [
    "home", "menu", "main menu", "search", "sitemap", "site map", "contact", "contact us", "about us",
    "login", "log in", "sign in", "register", "next", "previous", "next page", "previous page",
    "back to top", "read more", "show more", "skip to content", "share", "share this", "print",
    "accueil", "rechercher", "suivant", "précédent", "lire la suite", "haut de page",
    "startseite", "suche", "weiter", "zurück", "nach oben", "mehr lesen",
    "inicio", "buscar", "siguiente", "anterior", "leer más", "volver arriba",
]

#: phrases (lower case) of notices that sites put on every page
BOILERPLATE = [
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "uses cookies", "use of cookies", "accept cookies", "enable javascript", "javascript is disabled",
    "lorem ipsum", "click here", "subscribe to our newsletter", "sign up for our newsletter",
    "follow us on", "powered by wordpress", "page not found", "under construction",
    "tous droits réservés", "mentions légales", "politique de confidentialité",
    "alle rechte vorbehalten", "datenschutzerklärung", "cookies akzeptieren",
    "todos los derechos reservados", "política de privacidad", "aviso legal",
]


_LINE_COUNTS = ("word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_bad_lines", "lost_chars")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda total, x: total + x)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE_RUN, -1), "")


def _without(text: Column, letters: str) -> Column:
    return F.translate(text, letters, "")


def word_chars(text: Column) -> Column:
    """Code points in words."""
    return F.char_length(_without(text, SPACES))


def repeated_words(words: Column) -> Column:
    """Places of words that some 3-word window covers which stands twice or more.

    Texts whose windows all have different hashes hold no window twice. In the
    others windows are sorted with their places, so equal ones are neighbours.
    """
    count = F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))
    later = lambda i: [F.get(words, i + step) for step in range(1, WINDOW)]
    firsts = F.slice(words, F.lit(1), count)
    hashes = F.transform(firsts, lambda word, i: F.xxhash64(word, *later(i)))
    windows = F.transform(
        firsts, lambda word, i: F.struct(F.concat_ws(" ", word, *later(i)).alias("window"), i.alias("at"))
    )

    def places(ranked: Column) -> Column:
        same = lambda x, j: F.coalesce(x["window"] == F.get(ranked, j)["window"], F.lit(False))
        twice = F.filter(ranked, lambda x, j: same(x, j - 1) | same(x, j + 1))
        return F.sort_array(F.transform(twice, lambda x: x["at"]))

    def covered(at: Column) -> Column:
        new = lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - x, F.lit(WINDOW)))
        return _sum(F.transform(at, new))

    different = F.size(F.array_distinct(hashes)) == count
    return F.when(different, F.lit(0)).otherwise(_let(_let(F.sort_array(windows), places), covered))


def too_many_marks(line: Column) -> Column:
    """Punctuation rule."""
    return (line["marks"] >= MIN_MARKS) & (line["marks"] * 100 > line["chars"] * MAX_MARKS_PERCENT)


def is_navigation(line: Column) -> Column:
    """Navigation rule: a list of short items, or one line that is a menu entry."""
    text = line["line"]
    items = F.char_length(text) - F.char_length(_without(text, SEPARATORS))
    listed = (items >= MIN_SEPARATORS) & (F.size(words_of(text)) - items <= WORDS_PER_ITEM * (items + 1))
    entry = (line["chars"] <= max(map(len, NAVIGATION))) & F.lower(F.btrim(text, F.lit(SPACES))).isin(NAVIGATION)
    return (_any(text, list(SEPARATORS)) & listed) | entry


def is_boilerplate(line: Column) -> Column:
    """Boilerplate rule: the line has a phrase of a notice."""
    return _let(F.lower(line["line"]), lambda text: _any(text, BOILERPLATE))


def _any(text: Column, parts: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(part) for part in parts])


#: rule name -> rule on (line, chars, marks); the first that fits names what became of a line
LINE_RULES: dict[str, Callable[[Column], Column]] = {
    "navigation": is_navigation,
    "punctuation": too_many_marks,
    "boilerplate": is_boilerplate,
}


def _judged(line: Column) -> Column:
    failed = F.lit(None).cast("string")
    for name, rule in reversed(LINE_RULES.items()):
        failed = F.when(rule(line), name).otherwise(failed)
    symbols = F.char_length(line["line"]) - F.char_length(_without(line["line"], SYMBOLS))
    return F.struct(
        line["line"].alias("line"), line["chars"].alias("chars"),
        F.when(line["marks"] > 0, symbols).otherwise(0).alias("symbols"), failed.alias("failed"),
    )


def judge_lines(text: Column) -> Column:
    """Array of (line, chars, symbols, failed): each line, the code points in its
    words, its symbols, and the rule it fails, or NULL.

    Lines without a word fail none. Lines end at line feeds only.
    """
    counted = lambda line: F.struct(
        line.alias("line"), word_chars(line).alias("chars"),
        (F.char_length(line) - F.char_length(_without(line, MARKS))).alias("marks"),
    )
    return F.transform(F.transform(F.split(text, "\n", -1), counted), _judged)


def clean_lines(docs: DataFrame, text_col: str = "text", name: str = "quality") -> DataFrame:
    """``docs`` with a struct column ``name``: counts, verdict and the cleaned text.

    Its fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines, n_bad_lines, lost_chars (code points in words of removed lines),
    base_failed, kept, clean_text. NULL text counts as empty and fails, as texts of
    fewer than 50 words do; all rows and columns stay, repeated rows give
    repeated results, and an empty table gives no rows. A column that already
    has this name is replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    counts = _let(
        words_of(text),
        lambda words: F.struct(F.size(words).alias("n_words"), repeated_words(words).alias("n_repeat_words")),
    )

    def lines(judged: Column) -> Column:
        bad = F.filter(judged, lambda x: x["failed"].isNotNull())
        good = F.filter(judged, lambda x: x["failed"].isNull())
        worded = F.transform(F.filter(judged, lambda x: x["chars"] > 0), lambda x: x["line"])
        return F.struct(
            _sum(F.transform(judged, lambda x: x["chars"])).alias("word_chars"),
            _sum(F.transform(judged, lambda x: x["symbols"])).alias("n_symbols"),
            _let(worded, lambda found: F.size(found) - F.size(F.array_distinct(found))).alias("n_dup_lines"),
            F.size(judged).alias("n_lines"), F.size(bad).alias("n_bad_lines"),
            _sum(F.transform(bad, lambda x: x["chars"])).alias("lost_chars"),
            F.array_join(F.transform(good, lambda x: x["line"]), "\n").alias("clean_text"),
        )

    def whole(found: Column) -> Column:
        words, lines = found["words"], found["lines"]
        n, repeated = words["n_words"].cast("bigint"), words["n_repeat_words"].cast("bigint")
        lost, chars = lines["lost_chars"].cast("bigint"), lines["word_chars"].cast("bigint")
        failed = (n < MIN_WORDS) | (repeated * 100 > n * MAX_REPEATED_PERCENT)
        kept = ~failed & (lost * 100 <= chars * MAX_LOST_PERCENT)
        counts = [words[c].alias(c) for c in ("n_words", "n_repeat_words")]
        counts += [lines[c].alias(c) for c in _LINE_COUNTS]
        text = lines["clean_text"].alias("clean_text")
        return F.struct(*counts, failed.alias("base_failed"), kept.alias("kept"), text)

    found = F.struct(counts.alias("words"), _let(judge_lines(text), lines).alias("lines"))
    return docs.withColumn(name, _let(found, whole))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, counts, base_failed, kept) of every row; see ``clean_lines``."""
    judged = clean_lines(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    return judged.select(
        "doc_id",
        *[F.col(f"quality.{c}").cast("bigint").alias(c) for c in ("n_words", "n_repeat_words", *_LINE_COUNTS)],
        "quality.base_failed",
        "quality.kept",
    )
