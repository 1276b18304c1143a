"""URL filter: host rules first, then naive Bayes over segmented words.

Concatenated names are split into words by unigram Viterbi, with the counts of
all words of the text of all pages: the substrings of every different name meet
the table of counts in a join, so no model has to fit on one machine. Multinomial
naive Bayes learns from the urls that a rule decides and judges the others; its
weights are a table as well.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbed.llm.common import slices, staged

#: (verdict, host, path): a rule holds for its host and all hosts below it
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: letters of a word that a name may be split into
MAX_WORD_LETTERS = 24
#: odds are summed exactly, with this many places
PLACES = 9

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = r"\p{L}+|\p{N}+"
_NUMBER = "#"


def host_of(url: Column) -> Column:
    rest = F.substring_index(url, "://", 1)
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.length(rest) + 4)).otherwise("")
    return F.coalesce(F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.substring_index(url, "://", 1)
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.length(rest) + 4)).otherwise("")
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _matching(rules: list[tuple[str, str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits."""
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, at, start in reversed(longest):
        fits = ((host == at) | F.endswith(host, F.lit(f".{at}"))) & F.startswith(path, F.lit(start))
        name = F.when(fits, F.lit(at + start)).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n): all words of the text of all pages, without markup."""
    text = F.regexp_replace(F.lower("html"), "<[^>]*>", " ")
    words = F.regexp_extract_all(text, F.lit(r"\p{L}+"), F.lit(0))
    return pages.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


class Segmenter:
    """Unigram Viterbi: the split of a name with the largest product of word shares.

    ``counts`` needs the words that stand in the name only; ``total`` is that of all words.
    """

    def __init__(self, counts: dict[str, int], total: int | None = None):
        self.total = (sum(counts.values()) if total is None else total) or 1
        self.cost = {w: math.log(self.total / n) for w, n in counts.items()}

    def _cost(self, word: str) -> float:
        known = self.cost.get(word)
        # unseen words get rarer tenfold with each letter
        return math.log(self.total) + (len(word) - 1) * math.log(10) if known is None else known

    def split(self, name: str) -> tuple[str, ...]:
        """Of equally likely splits the one whose last words are shortest."""
        best = [(0.0, 0)]
        for end in range(1, len(name) + 1):
            starts = range(max(0, end - MAX_WORD_LETTERS), end)
            best.append(min((best[s][0] + self._cost(name[s:end]), -s) for s in starts))
        words, end = [], len(name)
        while end:
            start = -best[end][1]
            words.append(name[start:end])
            end = start
        return tuple(reversed(words))


def split_names(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words) of different names; ``counts`` is (word, n) of all words.

    A name meets each word that stands in it once, by a join on its substrings.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    at = F.sequence(F.lit(1), F.char_length("name"))
    # a start lies before the end, so no substring is shorter than told
    sizes = lambda i: F.sequence(F.lit(1), F.least(F.lit(MAX_WORD_LETTERS), F.char_length("name") - i + 1))
    inside = F.flatten(F.transform(at, lambda i: F.transform(sizes(i), lambda size: F.substring(F.col("name"), i, size))))
    parts = names.select("name", F.explode(F.array_distinct(inside)).alias("word"))
    known = parts.join(counts, "word").groupBy("name").agg(F.collect_list(F.struct("word", "n")).alias("known"))
    found = names.join(known, "name", "left")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for name, known in zip(batch["name"].to_pylist(), batch["known"].to_pylist()):
                segmenter = Segmenter({k["word"]: k["n"] for k in known or []}, total)
                out.append(segmenter.split(name))
            yield pa.record_batch([batch["name"], pa.array(out, pa.list_(pa.string()))], ["name", "words"])

    return found.mapInArrow(split, "name string, words array<string>")


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, host_words) of every row.

    ``verdict`` is the rule's, else that of the model (``block`` where its log
    odds are above zero). NULL urls and those without ``://`` have an empty host
    and path; no rule fits them and prior odds decide. If rules decide no url
    for one of both sides, nothing can be learned and the model allows. Repeated
    rows and rows without an id are judged like others; no rows give no rows.
    """
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    name, verdict = _matching(rules, F.col("host"), F.col("path"))
    parsed = parsed.select("page_id", "host", "path", name.alias("rule"), verdict.alias("ruled"))
    # numbered and written once, so that a row is known by its number
    rows = staged(parsed.withColumn("page_id", F.col("page_id").cast("bigint")).withColumn("row", F.monotonically_increasing_id()), "urls")
    words = _url_words(rows, pages)
    prior, weights, unseen = _bayes(rows, words)
    # all words of a url: bounded by its length
    told = words.join(weights, "token", "left").groupBy("row").agg(
        F.sum(F.coalesce("weight", F.lit(unseen).cast(_ODDS))).alias("sum"),
        F.sort_array(F.collect_list(F.when(F.startswith("token", F.lit("h:")), F.struct("at", "i", "token")))).alias("own"),
    )
    odds = F.lit(prior) + F.coalesce(F.col("sum").cast("double"), F.lit(0.0))
    scored = rows.join(told, "row", "left").withColumn("odds", odds)
    own = F.when(F.col("odds") > 0, "block").otherwise("allow")
    text = F.transform("own", lambda w: F.substr(w["token"], F.lit(3)))
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"),
        (1 / (1 + F.exp(-F.greatest(F.least("odds", F.lit(40.0)), F.lit(-40.0))))).alias("score"),
        F.coalesce(F.array_join(text, " "), F.lit("")).alias("host_words"),
    )


_ODDS = f"decimal(18,{PLACES})"


def _url_words(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """(row, ruled, at, i, token): words of hosts (``h:``) and paths (``p:``) in order, numbers as one word."""

    def named(kind: str, part: Column) -> Column:
        names = F.regexp_extract_all(part, F.lit(_TOKEN), F.lit(0))
        return F.transform(names, lambda name: F.struct(F.lit(kind).alias("kind"), name.alias("name")))

    parts = named("h:", F.col("host")), named("p:", F.lower("path"))
    found = rows.select("row", "ruled", F.posexplode(F.concat(*parts)).alias("at", "part"))
    found = staged(found.select("row", "ruled", "at", "part.kind", "part.name"), "url-names")
    is_name = F.col("name").rlike(r"^\p{L}")
    counts = staged(word_counts(pages), "url-counts")
    split = staged(split_names(found.filter(is_name).select("name").distinct(), counts), "url-splits")
    joined = found.join(split, "name", "left")
    words = F.coalesce("words", F.array(F.lit(_NUMBER)))
    each = joined.select("row", "ruled", "at", "kind", F.posexplode(words).alias("i", "word"))
    return staged(each.select("row", "ruled", "at", "i", F.concat("kind", "word").alias("token")), "url-words")


def _bayes(rows: DataFrame, words: DataFrame) -> tuple[float, DataFrame, float]:
    """(prior log odds, (token, weight) of every token, log odds of an unseen token) of ``block``."""
    block = F.when(F.col("ruled") == "block", 1).otherwise(0)
    seen = words.dropna(subset=["ruled"]).withColumn("block", block)
    counted = seen.groupBy("token").agg(F.sum("block").alias("b"), F.sum(1 - F.col("block")).alias("a"))
    counted = staged(counted, "url-tokens")
    sides = {r["ruled"]: r["count"] for r in rows.dropna(subset=["ruled"]).groupBy("ruled").count().collect()}
    if len(sides) < 2:
        return -40.0, counted.select("token", F.lit(0).cast(_ODDS).alias("weight")), 0.0
    sums = counted.agg(F.sum("b"), F.sum("a"), F.count("*")).first()
    all_b, all_a = sums[0] + sums[2] + 1, sums[1] + sums[2] + 1
    unseen = math.log(all_a / all_b)
    weight = F.log((F.col("b") + 1) / (F.col("a") + 1)) + unseen
    return math.log(sides["block"] / sides["allow"]), counted.select("token", weight.cast(_ODDS).alias("weight")), unseen
