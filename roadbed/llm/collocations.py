"""Collocations from count streams in prefix and suffix order.

Every word of a piece opens a window of up to three words. Windows are counted
within tasks, dealt into ranges and sorted by one number, whose first bits are a hash
of the first word and whose next ones of the second and third. So one stream has the
counts of words, pairs and triples at once: each is the sum of a run of
neighbouring rows. Runs that touch the border of a range, or a run whose hash is
the same, are summed once more.
The counted phrases are then merge-joined: in prefix order for the counts of
first parts, in suffix order for those of last parts, and in both for the most
frequent extension. No stage holds a table of phrases in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadbed.llm.common import slices, staged

#: occurrences a candidate has at least
MIN_COUNT = 10
#: a longer candidate with this share of a candidate's occurrences replaces it
ABSORBED_PERCENT = 50
#: phrases reported for each language
TOP = 2000
#: the score 1
SCALE = 1_000_000
#: language of texts that have none
NO_LANGUAGE = "und"

#: words a task counts in one go (some 200 MB), bytes of text cut at a time, rows sent at a time
CHUNK, PART, ROWS = 1 << 21, 1 << 22, 1 << 16
#: bits of the hashes of a window's words, 64 in sum
BITS = (25, 22, 17)
#: groups a language is ranked in before the best of them meet
SPREAD = 64

# Bytes that end a piece become line feeds, tabs blanks, A-Z a-z.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_BYTES = bytes.maketrans(
    _ENDS + b"\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n" * len(_ENDS) + b" abcdefghijklmnopqrstuvwxyz"
)

# rows hold text, whose bytes Spark compares in place
_WINDOWS = "head string, w2 string, w3 string, n bigint"
_COUNTED = "size int, head string, w2 string, w3 string, n bigint"


def tokens_of(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text in parts, with a line feed where a piece ends.

    A part ends where a piece does, so no window is cut.
    """
    text = text.translate(_BYTES)
    at = 0
    while at < len(text):
        end = text.find(b"\n", at + PART)
        end = len(text) if end < 0 else end
        words = text[at:end].replace(b"\n", b" \n ").split(b" ")
        yield [*filter(None, words), b"\n"]
        at = end + 1


def _count_windows(lang: bytes, tokens: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Different windows with their counts; an empty word counts all words.

    ``head`` is language, tab and first word: equal beginnings are neighbours
    in order of bytes, as no word has a tab.
    """
    column = pa.array(tokens, pa.binary()).dictionary_encode()
    words, code = column.dictionary, column.indices.to_numpy().astype(np.int64)
    size, end = len(words), words.index(pa.scalar(b"\n", pa.binary())).as_py()
    second, third = np.append(code[1:], end), np.append(code[2:], [end, end])[: len(code)]
    third = np.where(second == end, end, third)
    opens = code != end
    window = code[opens], second[opens], third[opens]
    if size**3 < 2**63:
        key, n = np.unique((window[0] * size + window[1]) * size + window[2], return_counts=True)
        window = key // (size * size), key // size % size, key % size
    else:  # a piece of more than CHUNK words
        key, n = np.unique(np.stack(window, axis=1), axis=0, return_counts=True)
        window = key.T
    # where a piece ends there is no word
    words = pc.if_else(pc.equal(words, b"\n"), pa.scalar(b"", pa.binary()), words)
    heads = pc.binary_join_element_wise(pa.scalar(lang, pa.binary()), words, pa.scalar(b"\t", pa.binary()))
    heads, words = heads.view(pa.string()), words.view(pa.string())
    columns = [heads.take(pa.array(window[0]))] + [words.take(pa.array(w)) for w in window[1:]] + [pa.array(n)]
    table = pa.record_batch(columns, ["head", "w2", "w3", "n"])
    for at in range(0, table.num_rows, ROWS):
        yield table.slice(at, ROWS)
    total = pa.array([lang + b"\t"], pa.binary()).view(pa.string())
    yield pa.record_batch([total, *[pa.array([""])] * 2, pa.array([int(opens.sum())])], table.schema.names)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[bytes, list[bytes]] = {}
    n = 0
    for batch in slices(batches):
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            for tokens in tokens_of(text):
                held.setdefault(lang, []).extend(tokens)
                n += len(tokens)
                if n >= CHUNK:
                    for found in held.items():
                        yield from _count_windows(*found)
                    held, n = {}, 0
    for found in held.items():
        yield from _count_windows(*found)


class _Runs:
    """Sums of runs of rows that share their first ``size`` columns.

    A run goes on over batches. Runs at either end of the stream may go on in
    another task, and runs next to one of the same hash further on, so they are told
    whatever their sum; others from ``least`` on.
    """

    def __init__(self, size: int, least: int):
        self.size, self.least = size, least
        # words, sum, and whether the run before has the same hash
        self.open: tuple[list[bytes], int, bool] | None = None
        self.inner = False  # whether a run has ended before

    def take(
        self, words: list[pa.Array], new: np.ndarray, met: np.ndarray, n: np.ndarray
    ) -> list[tuple[list[pa.Array], np.ndarray]]:
        """Ended runs of a batch.

        ``new`` marks rows that differ from the row before, ``met`` those of them that
        have its hash.
        """
        starts = np.flatnonzero(new)
        sums = np.add.reduceat(n, starts) if len(starts) else np.array([], np.int64)
        out = []
        before = int(n[: starts[0]].sum()) if len(starts) else int(n.sum())
        if self.open is not None:
            self.open = self.open[0], self.open[1] + before, self.open[2]
        if len(starts):
            met = met[starts]
            out += self.close(met[0])
            told = (sums[:-1] >= self.least) | met[:-1] | met[1:]
            if self.open is None and not self.inner:
                told[:1] = True  # the first run of all
            ended = np.flatnonzero(told)
            self.inner |= len(starts) > 1 or self.open is not None
            rows = pa.array(starts[ended])
            out.append(([w.take(rows) for w in words], sums[ended]))
            self.open = [w[int(starts[-1])].as_py() for w in words], int(sums[-1]), bool(met[-1])
        return out

    def close(self, told: bool) -> list[tuple[list[pa.Array], np.ndarray]]:
        """The run that was open, if it is to be told."""
        if self.open is None:
            return []
        words, total, met = self.open
        if not (told or met or not self.inner or total >= self.least):
            return []
        return [([pa.array([w], pa.binary()) for w in words], np.array([total]))]


def _hash_order(bits: tuple[int, int, int]) -> Column:
    """Number that windows are sorted by; never NULL, so Spark sorts it without comparing."""
    parts = [F.shiftrightunsigned(F.xxhash64(c), 64 - b) for c, b in zip(("head", "w2", "w3"), bits)]
    first, second = F.shiftleft(parts[0], bits[1] + bits[2]), F.shiftleft(parts[1], bits[2])
    return first.bitwiseOR(second).bitwiseOR(parts[2])


def _sum_runs(least: int, bits: tuple[int, int, int] = BITS):
    """Counts of words, pairs and triples of a stream of windows.

    They come in order of their hashes, told as ``place``, or without it in prefix order.
    """
    dropped = bits[1] + bits[2], bits[2], 0  # bits that are no part of the hash of a word, pair, triple

    def told(size: int, runs) -> Iterator[pa.RecordBatch]:
        for words, n in runs:
            nothing = pa.array([b""] * len(n), pa.binary())
            columns = [w.view(pa.string()) for w in [*words, nothing, nothing][:3]]
            sizes = pa.array(np.full(len(n), size, np.int32))
            found = pa.record_batch([sizes, *columns, pa.array(n)], ["size", "head", "w2", "w3", "n"])
            if size > 1:  # a window that ends early has no phrase of this size
                found = found.filter(pc.not_equal(columns[size - 1], ""))
            yield found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = [_Runs(size, least) for size in (1, 2, 3)]
        last: tuple[list[bytes], int] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            words, n = [batch[c].view(pa.binary()) for c in ("head", "w2", "w3")], batch["n"].to_numpy()
            hashed = "place" in batch.schema.names
            place = batch["place"].to_numpy() if hashed else np.zeros(batch.num_rows, np.int64)
            new, met = np.zeros(batch.num_rows, bool), np.zeros(batch.num_rows, bool)
            for i, (level, word, shift) in enumerate(zip(levels, words, dropped)):
                new[0] |= last is None or word[0].as_py() != last[0][i]
                new[1:] |= pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)
                own = place >> shift
                if hashed:
                    met[0] = new[0] and last is not None and own[0] == last[1] >> shift
                    met[1:] = new[1:] & (own[1:] == own[:-1])
                yield from told(level.size, level.take(words[: level.size], new, met, n))
            last = [w[-1].as_py() for w in words], int(place[-1])
        for level in levels:
            yield from told(level.size, level.close(True))

    return run


def phrase_counts(docs: DataFrame, least: int = MIN_COUNT, bits: tuple[int, int, int] = BITS) -> DataFrame:
    """(size, lang, w1, w2, w3, n): phrases of up to three words with ``least`` occurrences.

    Rows of size 1 without a word have the number of all words of a language. ``bits``
    tell how often hashes meet, which costs time and changes no count.
    """
    found = docs.select(
        F.coalesce("lang", F.lit(NO_LANGUAGE)).cast("binary").alias("lang"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    key = ["head", "w2", "w3"]
    place = _hash_order(bits)
    ordered = found.mapInArrow(_windows, _WINDOWS).repartitionByRange(place).sortWithinPartitions(place)
    # worked out again rather than shuffled with the rows
    runs = ordered.withColumn("place", place).mapInArrow(_sum_runs(least, bits), _COUNTED)
    counted = runs.groupBy("size", *key).agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    head = F.col("head")
    first = F.substring_index(head, "\t", -1)
    lang = F.substring(head, F.lit(1), F.char_length(head) - F.char_length(first) - 1)
    return counted.select(
        "size", lang.alias("lang"), first.alias("w1"), *key[1:], "n"
    )


def _lookup(counts: DataFrame, on: dict[str, str], **values: str) -> tuple[DataFrame, list[str]]:
    """``counts`` as the sorted right side of a merge join: keys and values renamed."""
    chosen = [F.col(old).alias(new) for new, old in on.items()] + [F.col(old).alias(new) for new, old in values.items()]
    return counts.select("lang", *chosen).hint("merge"), ["lang", *on]


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (left * right)), exact for counts of up to 14 digits."""
    wide = lambda c: c.cast("decimal(14,0)")
    return F.call_function("div", wide(a) * wide(a) * F.lit(SCALE).cast("decimal(7,0)"), wide(left) * wide(right))


def _cut(k: int) -> Column:
    """(score, k, l, r) of a triple that is cut after its first ``k`` words."""
    left, right = F.col(f"l{k}"), F.col(f"r{k}")
    score = _score(F.col("a"), left, right)
    return F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))


def scored_phrases(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of candidates that no longer one replaces."""
    words = counts.filter("size = 1 and w1 <> ''")
    pairs = counts.filter("size = 2").select("lang", "w1", "w2", F.col("n").alias("a"))
    triples = counts.filter("size = 3").select("lang", "w1", "w2", "w3", F.col("n").alias("a"))
    # prefix order, then suffix order
    pairs = pairs.join(*_lookup(words, {"w1": "w1"}, l="n")).join(*_lookup(words, {"w2": "w1"}, r="n"))
    pairs = staged(pairs, "collocation-pairs")
    triples = triples.join(*_lookup(pairs, {"w1": "w1", "w2": "w2"}, l1="l", l2="a"))
    triples = triples.join(*_lookup(pairs, {"w2": "w1", "w3": "w2"}, r1="a", r2="r"))
    triples = staged(triples, "collocation-triples")
    both = triples.select("lang", "w1", "w2", "a").union(triples.select("lang", "w2", "w3", "a"))
    longer = both.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
    kept = pairs.join(longer.hint("merge"), ["lang", "w1", "w2"], "left")
    kept = kept.filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * ABSORBED_PERCENT))
    score = _score(F.col("a"), F.col("l"), F.col("r"))
    of_two = kept.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", score.alias("score"))
    of_three = triples.withColumn("cut", F.least(_cut(1), _cut(2))).select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "cut.l", "cut.r", "cut.score"
    )
    return of_two.union(of_three)


def _best(df: DataFrame, group: list[str | Column], top: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.desc("a"), "phrase")
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def collocations(docs: DataFrame, top: int = TOP, least: int = MIN_COUNT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` collocations of each language.

    A phrase is a run of two or three words of a piece; pieces end at punctuation
    and line feeds. ``a`` counts the phrase, ``l`` and ``r`` its parts at the cut of
    lowest score, ``n`` all words of the language; score is a*a/(l*r) in
    millionths. NULL text is empty, NULL language ``und``; ids do not
    matter, repeated rows count as often as they stand, ties go by ``a``, then by
    the bytes of the phrase. An empty table gives no rows.
    """
    counts = staged(phrase_counts(docs, least), "collocation-counts")
    spread = F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))
    near_best = _best(scored_phrases(counts).withColumn("spread", spread), ["lang", "spread"], top)
    best = _best(near_best.drop("rank", "spread"), ["lang"], top)
    totals = counts.filter("size = 1 and w1 = ''").select("lang", F.col("n").alias("total"))
    # a row for each language
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
