"""Names and verdicts by all words, against Viterbi and Bayes over plain dictionaries; number signs."""

import math
import random
import re
from collections import Counter

from roadbed.llm import language_crf, url_filter

from .test_corpus_operators import brute_rule


def brute(rows):
    """(host words, odds, verdict) of every row, from plain counts of all words."""
    total = Counter(w for _, _, html in rows for w in re.findall(r"[^\W\d_]+", re.sub("<[^>]*>", " ", (html or "").lower())))
    segmenter = url_filter.Segmenter(dict(total))
    judged = []
    for _, url, _ in rows:
        host, path, rule, ruled = brute_rule(url)
        tokens = []
        for kind, part in (("h:", host), ("p:", path.lower())):
            for token in re.findall(r"[^\W\d_]+|\d+", part):
                tokens += [kind + w for w in (("#",) if token.isdigit() else segmenter.split(token))]
        judged.append((ruled, tokens))
    sides = Counter(r for r, _ in judged if r)
    b = Counter(t for r, tokens in judged if r == "block" for t in tokens)
    a = Counter(t for r, tokens in judged if r == "allow" for t in tokens)
    known = set(a) | set(b)
    all_b, all_a = b.total() + len(known) + 1, a.total() + len(known) + 1
    out = []
    for ruled, tokens in judged:
        odds = math.log(sides["block"] / sides["allow"])
        odds += sum(math.log((b[t] + 1) / all_b) - math.log((a[t] + 1) / all_a) for t in tokens)
        words = " ".join(t[2:] for t in tokens if t.startswith("h:"))
        out.append((words, odds, ruled or ("block" if odds > 0 else "allow")))
    return out


def test_verdicts_follow_from_all_words(spark):
    draw = random.Random(31)
    vocabulary = ["".join(draw.choice("abcdeé") for _ in range(draw.randint(2, 7))) for _ in range(3000)]
    rows = []
    for i in range(500):
        host = "".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 4)))
        end = draw.choice([".com/fr/", ".com/de/", ".net/", ".example.org/es/", ".org/"])
        html = " ".join(f"<p class='{draw.choice(vocabulary)}'>{draw.choice(vocabulary)}</p>" for _ in range(30))
        rows.append((i, f"http://{host}{end}{draw.choice(vocabulary)}{i % 7}", html))
    rows += [(1, None, "x" * 60 + " y"), (None, "no scheme", None), (7, "http://" + "ab" * 40 + ".net/", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = url_filter.judge_urls(pages.withColumn("row", pages.page_id).withColumn("token", pages.url).repartition(5)).collect()
    want = sorted((str(p), w, v) for (p, _, _), (w, _, v) in zip(rows, brute(rows)))
    assert sorted((str(r.page_id), r.host_words, r.verdict) for r in got) == want
    odds = sorted(round(1 / (1 + math.exp(-max(-40, min(40, o)))), 5) for _, o, _ in brute(rows))
    assert all(abs(x - y) < 1e-4 for x, y in zip(odds, sorted(r.score for r in got)))
    assert len({w for _, w, _ in want}) > 400 and {v for _, _, v in want} == {"allow", "block"}


def test_rare_words_count(spark):
    """A word that stands once in all pages splits a name, however many more frequent ones there are."""
    html = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)} " * 3 for i in range(5000)) + " rareword"
    pages = spark.createDataFrame([(1, "http://rarewordwaaa.net/", html)], "page_id bigint, url string, html string")
    assert url_filter.judge_urls(pages).first().host_words == "rareword waaa net"


def test_number_signs_are_no_letters(spark):
    docs = [(i * 3, t, lang) for i, (t, lang) in enumerate([("der und die", "de"), ("the and of", "en")] * 30)]
    crf = language_crf.train(spark.createDataFrame(docs, "doc_id bigint, text string, lang string"))
    odd = [(1, "½ ²"), (2, "Ⅷ"), (3, "③ 12 _"), (4, "x²"), (5, "ªº"), (6, "一")]
    found = language_crf.identify(spark.createDataFrame(odd, "doc_id bigint, text string"), crf).collect()
    assert {r.doc_id for r in found if r.lang_pred == "und"} == {1, 2, 3}
    assert language_crf.words_of("Ab½cd x² É") == ["ab", "cd", "x", "é"]
