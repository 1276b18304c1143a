"""Operators on single texts against brute force, plain libraries and held-out rows."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from roadbed.llm import bpe, language_crf, licenses, lz_fingerprint, toxicity
from roadbed.llm.common import slices

from .conftest import AWKWARD

PATH = public_tokenizers.path(bpe.RANKS)
RANKS = bpe.load_ranks(PATH)
CODER = bpe.TreeEncoder(RANKS)
PLAIN = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def test_a_worker_drops_the_encoder_when_it_serves_another_operator(spark):
    docs = spark.range(64).repartition(16).selectExpr("id AS doc_id", "concat('some words ', id) AS text")

    def encoders(batches):
        import gc

        for batch in slices(batches):
            found = sum(type(x).__name__ == "TreeEncoder" for x in gc.get_objects())
            yield pa.record_batch([pa.array([found])], ["n"])

    for _ in range(2):  # workers are used again in turn
        assert bpe.encode_documents(docs).filter("n_tokens > 0").count() == 64
        assert docs.mapInArrow(encoders, "n bigint").filter("n > 0").count() == 0


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("ab=é", max_size=400), st.text("etaoinshr", max_size=200)))
def test_bpe_is_the_plain_encoding(text):
    ids = CODER.encode(text)
    assert ids == PLAIN.encode_ordinary(text)
    assert CODER.decode(ids).decode() == text


@settings(max_examples=200, deadline=None)
@given(st.text("thenig", min_size=1, max_size=40), st.text("thenig", min_size=1, max_size=40))
def test_bpe_join_is_a_monoid(left, right):
    a, b = left.encode(), right.encode()
    assert CODER.join(CODER.tree(a), CODER.tree(b)) == CODER._merge(a + b)


def test_bpe_table(awkward, no_docs):
    rows = bpe.encode_documents(awkward, with_ids=True).collect()
    assert len(rows) == len(AWKWARD)
    for row, (_, text, _) in zip(rows, AWKWARD):
        ids = PLAIN.encode_ordinary(text or "")
        assert row.ids == ids and row.n_tokens == len(ids)
        assert row.ids_sha256 == sha(",".join(map(str, ids))) and row.decoded_sha256 == sha(text or "")
    assert bpe.encode_documents(no_docs).count() == 0


def brute_phrases(text):
    seen, at = set(), 0
    for end in range(1, len(text) + 1):
        if text[at:end] not in seen:
            seen.add(text[at:end])
            at = end
    return seen


@settings(max_examples=200, deadline=None)
@given(st.text("abé", max_size=80))
def test_lz_phrases(text):
    found = lz_fingerprint.Phrases().parse(text)
    assert len(found.edges) == len(brute_phrases(text)) == len(set(found.hashes)) - 1
    cut = len(text) // 2
    assert lz_fingerprint.Phrases().parse(text[:cut]).parse(text[cut:]).hashes == found.hashes


def test_lz_table(spark, awkward, no_docs, sf_dir):
    for docs, per_shard in ((awkward, 3), (spark.read.parquet(f"{sf_dir}/documents.parquet"), 17)):
        rows = lz_fingerprint.lz_fingerprints(docs, per_shard).collect()
        assert len(rows) == docs.count()
        from pyspark.sql import functions as F

        order = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).orderBy(
            F.col("doc_id").asc_nulls_last(), F.xxhash64("text")
        )
        want = [tuple(r) for r in order.collect()]
        rows.sort(key=lambda r: (r.doc_id is None, r.doc_id or 0, r.edited_sha256))
        texts = [t for _, t in want]
        made = []
        for (doc_id, text), following in zip(want, texts[1:] + texts[:1]):
            quarter = len(text) // 4
            edited = text[: len(text) - quarter] + following[:quarter]
            own, other, after = map(lz_fingerprint.fingerprint_of, (text, edited, following))
            near = float((own == other).mean()), float((own == after).mean())
            made.append((doc_id, len(text), sha(edited), own.astype(">u2").tobytes().hex(), *near))
        made.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
        got = [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.near_edited, r.near_next) for r in rows]
        assert got == made
    assert lz_fingerprint.lz_fingerprints(no_docs).count() == 0


LICENSED = [
    (1, "Released Under-the MIT\nLicense. And again: under the mit license", None),
    (2, "Apache License, Version 2.0", None),
    (3, "CC-BY-NC 4.0; cc by nc cc by nc", None),
    (4, "mit dem license", None),
    (5, "Licensed under the GNU General Public License, version 3", None),
    (6, "all rights reserved; spdx-license-identifier: BSD-3-Clause", None),
    (7, "under the MİT license", None),
]


def brute_licenses(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    starts, labels = [], set()
    for phrase, label in licenses.BASE.items():
        want = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(want)] == want]
        starts += at
        labels |= {label} if at else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_licenses(spark, awkward, no_docs, sf_dir):
    own = spark.createDataFrame(LICENSED, "doc_id int, text string, lang string")
    for docs in (own, awkward, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        want = sorted((str(r.doc_id), *map(str, brute_licenses(r.text))) for r in docs.collect())
        rows = licenses.scan_licenses(docs).collect()
        got = sorted(
            (str(r.doc_id), str(r.n_words), str(r.n_base), str(r.first_word), str(r.last_word), r.base_labels)
            for r in rows
        )
        assert got == want
        for r in rows:
            labels = [x for x in r.labels.split(",") if x]
            assert labels == sorted(set(labels)) and 0 <= r.score <= 1
            assert set(filter(None, r.base_labels.split(","))) <= set(labels)
    labels = {r.doc_id: r.labels for r in licenses.scan_licenses(own).collect()}
    assert labels[1] == "mit" and labels[2] == "apache-2" and labels[3] == "cc-by-nc"
    assert labels[4] == "" and labels[5] == "gpl-3" and labels[6] == "bsd-3,proprietary" and labels[7] == ""
    assert licenses.scan_licenses(no_docs).count() == 0
    assert sum(len(rules) for _, rules in licenses.rules()) > 200


def test_toxicity(spark, awkward, no_docs):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    rows = {r.doc_id: r for r in toxicity.toxicity(docs, model).collect()}
    toxic = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    held = [(rows[i].score, y) for i, y in toxic.items() if i in rows and rows[i].held_out]
    assert 0 < sum(y for _, y in held) < len(held)
    wins = np.mean([a > b for a, x in held if x for b, y in held if not y])
    assert wins > 0.9  # area under the curve on few rows
    dropped = docs.count() - toxicity.drop_toxic(docs, model).count()
    assert dropped == sum(r.predicted for r in rows.values())
    assert toxicity.toxicity(awkward, model).count() == len(AWKWARD)
    assert toxicity.drop_toxic(awkward, model).columns == awkward.columns
    assert toxicity.toxicity(no_docs, model).count() == 0
    nothing = toxicity.train(no_docs, labels.limit(0))
    assert {r.predicted for r in toxicity.toxicity(awkward, nothing).collect()} == {0}


def test_language(spark, awkward, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    crf = language_crf.train(docs)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = language_crf.identify(docs, crf).collect()
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)
    found = {r.doc_id: r for r in language_crf.identify(awkward, crf).collect()}
    assert {i for i, r in found.items() if r.lang_pred == "und"} == {2, 3, 4}
    assert language_crf.identify(no_docs, crf).count() == 0
    untaught = language_crf.train(no_docs)
    assert {r.lang_pred for r in language_crf.identify(awkward, untaught).collect()} == {"und"}


def test_forward_backward_is_exact():
    draw = np.random.default_rng(1)
    e, step = draw.random((3, language_crf.CHAIN, 2)) + 0.1, draw.random((2, 2)) + 0.1
    sizes = [4, 1, 7]
    live = np.arange(language_crf.CHAIN) < np.array(sizes)[:, None]
    e = np.where(live[..., None], e, 1.0)
    gamma, _, _ = language_crf.forward_backward(e, live, step)
    for c, n in enumerate(sizes):
        weight = np.zeros((n, 2))
        for path in np.ndindex(*[2] * n):
            w = np.prod([e[c, t, y] for t, y in enumerate(path)])
            w *= np.prod([step[a, b] for a, b in zip(path, path[1:])])
            for t, y in enumerate(path):
                weight[t, y] += w
        assert gamma[c, :n] == pytest.approx(weight / weight.sum(axis=1, keepdims=True))
