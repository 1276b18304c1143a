"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadbed.llm import (
    bpe,
    collocations,
    decontam,
    language_crf,
    licenses,
    line_dedup,
    line_quality,
    lz_fingerprint,
    simhash,
    spelling,
    toxicity,
    url_filter,
    warc,
)
from roadbed.llm.common import on_workers


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.new_archive(spark)
    warc.write_warc(_table(spark, sf_dir, "pages"), folder)
    records = warc.read_warc(spark, folder, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op2_lz_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_fingerprint.lz_fingerprints(_table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(_table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_classes(_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language_crf.identify(docs, language_crf.train(docs))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def op12_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.quality(_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_warc, op2_lz_fingerprints, op3_license_scan, op4_bpe, op5_line_dedup,
        op6_toxicity, op7_decontamination, op8_language_id, op9_simhash, op10_url_filter,
        op11_spelling, op12_line_quality, op13_collocations,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express; the others have brute-force tests."""
    return {"op1_warc": _OP1, "op12_line_quality": _op12(), "op13_collocations": _OP13}


_OP1 = """
with p as (
  select page_id, coalesce(html, '') as html, sha256(coalesce(html, '')) as payload_digest,
         octet_length(encode(coalesce(html, ''))) as payload_bytes
  from pages
), f as (
  select *, min(page_id) over (partition by payload_digest) as first from p
)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
       case when payload_bytes >= 100 and page_id is distinct from first and first is not null
            then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and page_id is distinct from first and first is not null
            then first end as refers_to,
       true as intact
from f
"""


def _op12() -> str:
    """The rules as SQL, from the same lists."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    spaces = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    without = lambda text, letters: f"translate({text}, {letters}, '')"
    notices = " or ".join(f"contains(lower(line), {quoted(p)})" for p in line_quality.BOILERPLATE)
    entries = ", ".join(map(quoted, line_quality.NAVIGATION))
    words = "list_filter(regexp_split_to_array({}, '[ \\x09-\\x0d]+'), lambda w: w <> '')"
    return f"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
), t as (
  select *, {words.format("text")} as ws from d
), w as (
  select r, unnest(ws) as w1, unnest(range(len(ws))) as i from t
), g as (
  select r, i, w1, lead(w1) over p as w2, lead(w1, 2) over p as w3 from w window p as (partition by r order by i)
), c as (
  select r, i, w3 is not null and count(*) over (partition by r, w1, w2, w3) > 1 as twice from g
), m as (
  select r, twice or coalesce(lag(twice) over p, false) or coalesce(lag(twice, 2) over p, false) as covered
  from c window p as (partition by r order by i)
), rep as (
  select r, count(*) filter (where covered) as n_repeat_words from m group by r
), l as (
  select r, unnest(string_split(text, chr(10))) as line from d
), f as (
  select r, line, length({without("line", spaces)}) as chars,
         length(line) - length({without("line", quoted(line_quality.MARKS))}) as marks,
         length(line) - length({without("line", quoted(line_quality.SYMBOLS))}) as symbols,
         length(line) - length({without("line", quoted(line_quality.SEPARATORS))}) as items,
         len({words.format("line")}) as n
  from l
), j as (
  select *, (marks >= {line_quality.MIN_MARKS} and marks * 100 > chars * {line_quality.MAX_MARKS_PERCENT})
            or (items >= {line_quality.MIN_SEPARATORS} and n - items <= {line_quality.WORDS_PER_ITEM} * (items + 1))
            or lower(trim(line, {spaces})) in ({entries})
            or {notices} as bad
  from f
), s as (
  select r, count(*) as n_lines, count(*) filter (where bad) as n_bad_lines, sum(chars) as word_chars,
         coalesce(sum(chars) filter (where bad), 0) as lost_chars, sum(symbols) as n_symbols,
         count(*) filter (where chars > 0) - count(distinct line) filter (where chars > 0) as n_dup_lines
  from j group by r
), a as (
  select doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
         cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
         cast(n_dup_lines as bigint) as n_dup_lines, cast(n_lines as bigint) as n_lines,
         cast(n_bad_lines as bigint) as n_bad_lines, cast(lost_chars as bigint) as lost_chars
  from t join s using (r) left join rep using (r)
)
select *, n_words < {line_quality.MIN_WORDS}
          or 100 * n_repeat_words > {line_quality.MAX_REPEATED_PERCENT} * n_words as base_failed,
       not base_failed and lost_chars * 100 <= word_chars * {line_quality.MAX_LOST_PERCENT} as kept
from a
"""


_OP13 = """
with d as (
  select coalesce(lang, 'und') as lang, row_number() over () as r,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents
), p as (
  select lang, r, unnest(regexp_split_to_array(text, '[.,;:!?\\x0a-\\x0d]')) as piece from d
), q as (
  select lang, row_number() over () as p, list_filter(regexp_split_to_array(piece, '[ \\x09]+'), lambda w: w <> '') as ws
  from p
), t as (
  select lang, p, unnest(ws) as w1, unnest(range(len(ws))) as i from q
), g as (
  select lang, w1, lead(w1) over s as w2, lead(w1, 2) over s as w3 from t window s as (partition by p order by i)
), n as (
  select lang, count(*) as n from t group by lang
), u as (
  select lang, w1, count(*) as f from g group by all
), b as (
  select lang, w1, w2, count(*) as f from g where w2 is not null group by all having count(*) >= 10
), c as (
  select lang, w1, w2, w3, count(*) as f from g where w3 is not null group by all having count(*) >= 10
), two as (
  select b.lang, b.w1 || ' ' || b.w2 as phrase, b.f as a, x.f as l, y.f as r
  from b join u x on x.lang = b.lang and x.w1 = b.w1 join u y on y.lang = b.lang and y.w1 = b.w2
  where not exists (select 1 from c where c.lang = b.lang and c.w1 = b.w1 and c.w2 = b.w2 and 100 * c.f >= 50 * b.f)
    and not exists (select 1 from c where c.lang = b.lang and c.w2 = b.w1 and c.w3 = b.w2 and 100 * c.f >= 50 * b.f)
), three as (
  select c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3 as phrase, c.f as a,
         x.f as l1, y.f as r1, v.f as l2, z.f as r2
  from c join u x on x.lang = c.lang and x.w1 = c.w1
         join b y on y.lang = c.lang and y.w1 = c.w2 and y.w2 = c.w3
         join b v on v.lang = c.lang and v.w1 = c.w1 and v.w2 = c.w2
         join u z on z.lang = c.lang and z.w1 = c.w3
), cuts as (
  select lang, phrase, a, l, r, 1 as k from two
  union all select lang, phrase, a, l1, r1, 1 from three
  union all select lang, phrase, a, l2, r2, 2 from three
), s as (
  select *, cast(cast(1000000 as hugeint) * a * a // (cast(l as hugeint) * r) as bigint) as score from cuts
), o as (
  select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1
), best as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from o
)
select lang, rank, phrase, a, l, r, n.n as n, score from best join n using (lang) where rank <= 2000
"""
