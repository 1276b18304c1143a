"""Line rules: base counts against plain Python, rules by example, odd rows."""

import re
from collections import Counter

import duckdb
import pytest

from roadbed.llm import line_quality, queries
from tests.compare import differences, open_tables


def base_of(text: str) -> dict:
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    windows = list(zip(words, words[1:], words[2:]))
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + step for i, w in enumerate(windows) if w in twice for step in range(3)}
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall("[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 50 or 100 * len(covered) > 50 * len(words),
    }


TEXTS = [
    "", " \t\r\n\x0b\x0c ", "a", "a b", "a b c", "a b c a b c", "x x x x x", "one\ntwo\none\n\n\none ",
    "a b c d a b c e b c d", "𝒳 é b #*$%&|<> \x85 c", "word " * 30_000, "same line of text\n" * 4_000,
    "no break " + "z" * 1_200_000, " ".join(f"w{i % 977}" for i in range(20_000)), "\x00 \x01 a\x00b",
]


def test_base_counts_equal_plain_python(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id bigint, text string")
    for row in line_quality.quality(docs).collect():
        expected = base_of(TEXTS[row.doc_id])
        assert {k: row[k] for k in expected} == expected, row.doc_id


PROSE = " ".join(f"A{i} line{i} of{i} prose{i}, with{i} a comma and a full stop{i}." for i in range(12))


@pytest.mark.parametrize(
    "line, rule",
    [
        ("Buy!!! now!!! cheap!!!", "punctuation"),
        ("a### b&&& c%%% d$$$", "punctuation"),
        ("Home | About us | Products | Contact", "navigation"),
        ("  Back to top \r", "navigation"),
        ("© 2020, All Rights Reserved", "boilerplate"),
        ("This site uses cookies to work.", "boilerplate"),
        ("Wait! He said so.", None),
        ("One | two", None),
        ("Home is where the heart is.", None),
        ("", None),
    ],
)
def test_line_rules(spark, line, rule):
    docs = spark.createDataFrame([(f"{PROSE}\n{line}",)], "text string")
    found = docs.select(line_quality.judge_lines(docs.text)[1].failed).first()[0]
    assert found == rule


def test_bad_lines_go_and_texts_that_lose_most_are_rejected(spark):
    nav = "one | two | three | four"
    rows = [(1, f"{PROSE}\n{nav}\nThe end."), (2, "\n".join([nav] * 60)), (3, PROSE)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.quality for r in line_quality.clean_lines(docs).collect()}
    assert found[1].clean_text == f"{PROSE}\nThe end." and found[1].kept and found[1].n_bad_lines == 1
    assert found[2].clean_text == "" and not found[2].kept and found[2].lost_chars == found[2].word_chars
    assert found[3].kept and found[3].clean_text == PROSE


def test_awkward_rows(spark, awkward, no_docs):
    rows = line_quality.quality(awkward).collect()
    assert len(rows) == awkward.count()
    assert sorted(r.n_words for r in rows if r.doc_id in (2, 3)) == [0, 0]
    assert sum(r.doc_id is None for r in rows) == 1
    assert [r.n_words for r in rows if r.doc_id == 1] == [16, 16]
    assert set(awkward.columns) < set(line_quality.clean_lines(awkward).columns)
    assert line_quality.quality(no_docs).count() == 0


def test_query_equals_sql(spark, sf_dir):
    got = queries.queries()["op12_line_quality"](spark, sf_dir).toPandas()
    assert differences(got, open_tables(sf_dir).execute(queries.oracle_sql()["op12_line_quality"]).df()) == ""


def test_clean_documents_stay_and_bad_ones_go(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.queries()["op12_line_quality"](spark, sf).toPandas()
    labels = duckdb.sql(f"select doc_id, quality from '{sf}/labels.parquet'").df().merge(found, on="doc_id")
    judged = labels[~labels.base_failed]
    assert judged[judged.quality == 1].kept.all() and not judged[judged.quality == 0].kept.any()


def test_native_plan(spark, sf_dir):
    plan = queries.queries()["op12_line_quality"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange|Join", plan)
