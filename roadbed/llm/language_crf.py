"""Language of words in code-switched text: a linear-chain CRF.

A word's features are its letter bigrams and trigrams with word borders, its
first and last three letters, and itself (the lexicon), all hashed. A chain is
up to ``CHAIN`` consecutive words of a text; learned transitions tie neighbours,
and forward-backward gives each word's language. A text gets the language with
the largest mean over its words. Training texts are cut and spliced, so that
the chains a model learns from switch languages.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbed.llm.common import held_out, slices, texts

CHAIN = 32
TABLE_BITS = 16
#: texts a model is learned from, at most
MAX_TRAIN_DOCS = 3000
EPOCHS = 2
BATCH_DOCS = 64
RATE = 0.3

_QUICK, _LETTERS = re.compile(r"[^\W\d_]+").findall, regex.compile(r"\p{L}+").findall
_POWERS = np.cumprod(np.full(512, 0x9E3779B97F4A7C15, np.uint64))


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased; number signs such as fractions are none."""
    text = text.lower()
    found = _QUICK(text)
    return found if "".join(found).isalpha() else _LETTERS(text)


@dataclass
class Features:
    """Hashed features of a list of words: those of letters, and three of each word."""

    letters: np.ndarray  # (2, letters): bigram and trigram around each letter
    starts: np.ndarray  # first letter of each word
    words: np.ndarray  # (3, words): prefix, suffix, word

    @property
    def size(self) -> int:
        return len(self.starts)


def _bucket(x: np.ndarray, kind: int) -> np.ndarray:
    x = (x + np.uint64(kind * 0x51ED270B)) * np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def features(words: list[str]) -> Features:
    line = " " + " ".join(words) + " "
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    letter = np.flatnonzero(codes != 32)
    before, here, after = codes[letter - 1], codes[letter], codes[letter + 1]
    bigram, trigram = (before << np.uint64(21)) | here, (before << np.uint64(42)) | (here << np.uint64(21)) | after
    starts = np.flatnonzero(before == 32)
    size = np.diff(np.append(starts, len(letter)))
    ends = starts + size - 1
    place = np.arange(len(letter)) - np.repeat(starts, size)
    whole = np.add.reduceat(here * _POWERS[place % 512], starts)
    # letters one and two, with a border where a word ends sooner
    second, last_but = after[starts], before[ends]
    third = np.where(size > 2, here[np.minimum(starts + 2, ends)], 0)
    third_last = np.where(size > 2, here[np.maximum(ends - 2, starts)], 0)
    prefix = (here[starts] << np.uint64(42)) | (second << np.uint64(21)) | third
    suffix = (here[ends] << np.uint64(42)) | (last_but << np.uint64(21)) | third_last
    return Features(
        np.stack([_bucket(bigram, 1), _bucket(trigram, 2)]), starts,
        np.stack([_bucket(prefix, 3), _bucket(suffix, 4), _bucket(whole, 5)]),
    )


def emissions(f: Features, table: np.ndarray) -> np.ndarray:
    """(words, labels): summed weights of each word's features."""
    letters = table[f.letters[0]] + table[f.letters[1]]
    return np.add.reduceat(letters, f.starts) + table[f.words].sum(axis=0)


def chains(sizes: list[int]) -> np.ndarray:
    """(chains, CHAIN): word numbers of each chain, -1 behind the end of a text."""
    out, at = [], 0
    for size in sizes:
        n = -(-size // CHAIN)
        index = np.arange(n * CHAIN)
        out.append(np.where(index < size, index + at, -1).reshape(n, CHAIN))
        at += size
    return np.concatenate(out) if out else np.zeros((0, CHAIN), np.int64)


def forward_backward(e: np.ndarray, live: np.ndarray, step: np.ndarray):
    """(gamma, alpha, right) of chains: posteriors, and what pair posteriors need.

    ``e`` holds (chains, CHAIN, labels) emission factors, ``step`` the factors of
    transitions. Every place is scaled by its own sum.
    """
    alpha, right = np.empty_like(e), np.ones_like(e)
    beta = np.ones_like(e)
    alpha[:, 0] = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, e.shape[1]):
        now = (alpha[:, t - 1] @ step) * e[:, t]
        alpha[:, t] = now / now.sum(axis=1, keepdims=True)
    for t in range(e.shape[1] - 2, -1, -1):
        right[:, t + 1] = e[:, t + 1] * beta[:, t + 1]
        now = right[:, t + 1] @ step.T
        now /= now.sum(axis=1, keepdims=True)
        beta[:, t] = np.where(live[:, t + 1, None], now, 1.0)
    gamma = alpha * beta
    return gamma / gamma.sum(axis=2, keepdims=True), alpha, right


@dataclass
class Crf:
    labels: list[str]
    table: np.ndarray
    steps: np.ndarray

    def posteriors(self, docs: list[list[str]]) -> list[np.ndarray]:
        """(words, labels) of each text; no text may be without words."""
        if not docs:
            return []
        e = np.concatenate([emissions(features(words), self.table) for words in docs])
        index = chains([len(words) for words in docs])
        gamma, _, _ = forward_backward(*_factors(e, index), np.exp(self.steps))
        flat = gamma.reshape(-1, gamma.shape[2])[index.ravel() >= 0]
        return np.split(flat, np.cumsum([len(words) for words in docs])[:-1])


def _factors(e: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    live = index >= 0
    e = np.exp(np.clip(e - e.max(axis=1, keepdims=True), -30, 0))
    return np.where(live[..., None], e[index], 1.0), live


def fit(rows: list[tuple[str, list[str]]]) -> Crf:
    """Model of (language, words) rows, by adaptive gradient steps on the likelihood."""
    labels = sorted({lang for lang, _ in rows})
    k = len(labels)
    crf = Crf(labels, np.zeros((1 << TABLE_BITS, k), np.float32), np.zeros((k, k)))
    table_sum, steps_sum = np.full(crf.table.shape, 1e-3, np.float32), np.full((k, k), 1e-3)
    draw = np.random.default_rng(0)
    for _ in range(EPOCHS):
        order = draw.permutation(len(rows))
        for at in range(0, len(rows), BATCH_DOCS):
            batch = [rows[i] for i in order[at : at + BATCH_DOCS]]
            own = [features(words) for _, words in batch]
            truth = np.repeat([labels.index(lang) for lang, _ in batch], [f.size for f in own])
            e = np.concatenate([emissions(f, crf.table) for f in own])
            index = chains([f.size for f in own])
            splice = draw.permutation(len(index))
            half = draw.random(len(index)) < 0.5
            index[half, CHAIN // 2 :] = index[splice][half, CHAIN // 2 :]
            # a chain may not go on behind its end
            index[half & (index[:, CHAIN // 2 - 1] < 0), CHAIN // 2 :] = -1
            factors, live = _factors(e, index)
            step = np.exp(crf.steps)
            gamma, alpha, right = forward_backward(factors, live, step)
            gold = np.zeros_like(gamma)
            np.put_along_axis(gold, truth[index][..., None], 1.0, axis=2)
            g = np.zeros_like(e)
            np.add.at(g, index[live], (gamma - gold)[live])
            pairs = alpha[:, :-1, :, None] * step * right[:, 1:, None, :]
            pairs /= pairs.sum(axis=(2, 3), keepdims=True)
            pairs -= gold[:, :-1, :, None] * gold[:, 1:, None, :]
            g_steps = pairs[live[:, 1:]].sum(axis=0) / max(1, len(index))
            _descend(crf.table, table_sum, _table_gradient(own, g) / len(index))
            _descend(crf.steps, steps_sum, g_steps)
    return crf


def _table_gradient(own: list[Features], g: np.ndarray) -> np.ndarray:
    buckets, rows, at = [], [], 0
    for f in own:
        of_letter = np.repeat(np.arange(f.size), np.diff(np.append(f.starts, f.letters.shape[1]))) + at
        buckets += [*f.letters, *f.words]
        rows += [of_letter, of_letter, *[np.arange(f.size) + at] * 3]
        at += f.size
    bucket, row = np.concatenate(buckets), np.concatenate(rows)
    return np.stack([np.bincount(bucket, g[row, c], 1 << TABLE_BITS) for c in range(g.shape[1])], axis=1)


def _descend(x: np.ndarray, squares: np.ndarray, g: np.ndarray) -> None:
    squares += (g * g).astype(squares.dtype)
    x -= (RATE * g / np.sqrt(squares)).astype(x.dtype)


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task: the sample is bounded."""
    rows = [
        (doc_id, lang, words)
        for batch in slices(batches)
        for doc_id, lang, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "lang", "text")))
        if (words := words_of(text))
    ]
    rows.sort()
    crf, out = fit([row[1:] for row in rows]), io.BytesIO()
    np.savez_compressed(out, labels=np.array(crf.labels, str), table=crf.table, steps=crf.steps)
    yield pa.record_batch([pa.array([out.getvalue()], pa.binary())], ["model"])


def train(docs: DataFrame, max_docs: int = MAX_TRAIN_DOCS) -> Crf:
    """Model of ``lang`` from the texts of rows that are not held out.

    Rows with a NULL id, text or language teach nothing.
    """
    known = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "text").dropna()
    known = known.filter(~held_out(F.col("doc_id")))
    share = int(1e9 * min(1.0, max_docs / max(1, known.count())))
    sample = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000_000)) < share)
    # the scan stays spread out; only the sample meets in one task
    blob = sample.repartition(1).mapInArrow(_learn, "model binary").first()[0]
    with np.load(io.BytesIO(blob)) as saved:
        return Crf(saved["labels"].tolist(), saved["table"], saved["steps"])


def identify(docs: DataFrame, crf: Crf) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, n_switches) of every row.

    ``score`` is the mean posterior of the predicted language, ``n_switches``
    the number of neighbours labelled differently. NULL texts and texts without
    a letter are ``und`` with score 0, as all are when nothing was learned.
    Repeated rows and rows without an id are labelled like others; an empty
    table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(crf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, 64):
            words = [words_of(t) for t in batch["text"].to_pylist()]
            found = iter(model.posteriors([w for w in words if w]) if model.labels else [])
            out = []
            for w in words:
                if not w or not model.labels:
                    out.append(("und", 0.0, 0))
                    continue
                p = next(found)
                mean, each = p.mean(axis=0), p.argmax(axis=1)
                best = int(mean.argmax())
                out.append((model.labels[best], min(1.0, float(mean[best])), int((each[1:] != each[:-1]).sum())))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.float64(), pa.int64()))]
            yield pa.record_batch([batch["doc_id"], *columns], ["doc_id", "lang_pred", "score", "n_switches"])

    schema = "doc_id bigint, lang_pred string, score double, n_switches bigint"
    return texts(docs).mapInArrow(run, schema).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "n_switches"
    )
