"""Lempel-Ziv phrase fingerprints: minimum hashes of a document's LZ78 phrases."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbed.llm.common import NULL_KEY, ordered_shards, shard_of, slices, texts

#: minimum hashes of 16 bits in a fingerprint
BINS = 128
#: documents of a shard that is streamed in order
ROWS_PER_SHARD = 2000

_MASK = (1 << 61) - 1
_FACTOR = 0x1E3779B97F4A7C15
_SEED = 7


class Phrases:
    """Trie of the phrases seen so far; a phrase is the shortest one not seen before.

    A node is its number shifted left by 21 bits, so an edge is node + code point.
    """

    def __init__(self):
        self.edges: dict[int, int] = {}
        self.hashes = [_SEED]
        self.open = 0

    def fork(self) -> Phrases:
        twin = Phrases()
        twin.edges, twin.hashes, twin.open = self.edges.copy(), self.hashes.copy(), self.open
        return twin

    def parse(self, text: str) -> Phrases:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).tolist()
        edges, hashes, node = self.edges, self.hashes, self.open
        get = edges.get
        for code in codes:
            edge = node | code
            after = get(edge)
            if after is None:
                edges[edge] = len(hashes) << 21
                hashes.append((hashes[node >> 21] * _FACTOR + code) & _MASK)
                node = 0
            else:
                node = after
        self.open = node
        return self


def signature(phrases: Phrases) -> np.ndarray:
    """Smallest hash in each of ``BINS`` ranges; an empty range borrows the next."""
    if len(phrases.hashes) == 1:
        return np.zeros(BINS, np.uint16)
    x = np.array(phrases.hashes[1:], np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x = np.sort(x ^ (x >> np.uint64(31)))
    edges = np.arange(BINS, dtype=np.uint64) << np.uint64(57)
    at = np.searchsorted(x, edges)
    filled = np.flatnonzero(np.append(at[1:], len(x)) > at)
    lender = filled[np.searchsorted(filled, np.arange(BINS)) % len(filled)]
    value = (x[at[lender]] >> np.uint64(20)).astype(np.uint16)
    return value + ((lender - np.arange(BINS)) % BINS).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal minimum hashes, an estimate of the Jaccard index."""
    return float((a == b).mean())


def fingerprint_of(text: str) -> np.ndarray:
    return signature(Phrases().parse(text))


def _hex(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u2").tobytes().hex()


class _Open:
    """A document whose next one has not been seen yet.

    Its edited text starts like itself, so the parse is forked where they part.
    """

    def __init__(self, doc_id: int | None, text: str):
        self.doc_id, self.n_chars = doc_id, len(text)
        self.quarter = len(text) // 4
        self.kept = text[: len(text) - self.quarter]
        phrases = Phrases().parse(self.kept)
        self.forked = phrases.fork()
        self.own = signature(phrases.parse(text[len(self.kept) :]))

    def report(self, following: str, next_own: np.ndarray) -> tuple:
        borrowed = following[: self.quarter]
        edited = signature(self.forked.parse(borrowed))
        sha = hashlib.sha256((self.kept + borrowed).encode("utf-8", "surrogatepass")).hexdigest()
        near = likeness(self.own, edited), likeness(self.own, next_own)
        return self.doc_id, self.n_chars, sha, _hex(self.own), _hex(edited), *near


_SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
_TYPES = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
_NAMES = [column.split()[0] for column in _SCHEMA.split(", ")]


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row is reported when the one after it in its shard is known."""
    before: tuple[int, _Open] | None = None
    for batch in slices(batches, 128):
        out = []
        shards, ids, tails, rows = (batch[c].to_pylist() for c in ("shard", "doc_id", "tail", "text"))
        for shard, doc_id, tail, text in zip(shards, ids, tails, rows):
            now = _Open(doc_id, text)
            if before and before[0] == shard:
                out.append(before[1].report(text, now.own))
            before = None if tail else (shard, now)
        columns = zip(*out) if out else [[] for _ in _TYPES]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, _TYPES)], _NAMES)


def lz_fingerprints(docs: DataFrame, rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """Fingerprint of every text, of its edited text, and their likeness.

    The edited text ends in the start of the next document, so documents are
    dealt once into ranges of exact rank and streamed in order; the first row of
    each range is also given to the range before it (that of the first range to
    the last one). Order is doc_id, then a hash of the text; rows without an id
    come last. A single row is its own next one. NULL and empty texts have an
    empty phrase set, which is alike to empty ones only. No rows give no rows.
    """
    keyed = texts(docs).select(
        "doc_id", "text",
        F.coalesce("doc_id", F.lit(NULL_KEY)).alias("key"), F.xxhash64("text").alias("tie"),
    )
    bounds = ordered_shards(keyed, "key", "tie", rows_per_shard)
    body = keyed.withColumn("shard", shard_of(bounds, "key", "tie")).withColumn("tail", F.lit(False))
    # max_shards rows at most; repeated rows are the same text
    spark = docs.sparkSession
    firsts = spark.createDataFrame(
        [(k, t, (i or len(bounds)) - 1) for i, (k, t) in enumerate(bounds)],
        "key bigint, tie bigint, shard int",
    )
    tails = (
        keyed.join(F.broadcast(firsts), ["key", "tie"])
        .dropDuplicates(["shard"])
        .withColumn("tail", F.lit(True))
    )
    dealt = body.unionByName(tails).repartition("shard")
    ordered = dealt.sortWithinPartitions("shard", "tail", "key", "tie")
    return ordered.select("shard", "doc_id", "tail", "text").mapInArrow(_stream, _SCHEMA)
