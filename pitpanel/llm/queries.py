"""Queries of the corpus operators, each over a whole table, and their SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import scratch
from . import blobscan, decontam, extraction, linededup, media, mixing, phrases, pii, quality, simhash, tokens, toxicity, vectorcodes
from .common import table


def op1_media_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.features(media.encode(table(spark, sf_dir, "documents")))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.without_boilerplate(table(spark, sf_dir, "documents")).select("doc_id", "source", "text", "n_chars", "n_lines", "n_removed")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.select(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id", "source", "lang", "n_chars"])


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier version of the corpus, about half of its rows, is scanned into a stored ledger
    first; the whole corpus then opens it and scans only what it lacks."""
    docs = table(spark, sf_dir, "documents")
    earlier = docs.where(F.xxhash64("doc_id") % 2 == 0)
    root = scratch(spark, "blob-ledger")
    blobscan.StoredLedger(spark, root).update(earlier)
    return blobscan.find_secrets(docs, ledger=blobscan.StoredLedger(spark, root))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.compress(table(spark, sf_dir, "embeddings"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_media_matroska, op2_simhash, op3_mixing, op4_decontamination, op5_toxicity, op6_line_dedup, op7_quality, op8_token_counts, op9_secrets,
        op10_personal_data, op11_html_text, op12_vector_codes, op13_phrases,
    )
    return {f.__name__: f for f in found}


MIXING_SQL = r"""with s as (select row_number() over () as i, doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
    md5(coalesce(cast(doc_id as varchar), '') || ':' || coalesce(text, '')) as key from documents),
  p as (select source, cast(sum(size) as bigint) as source_size from s group by 1),
  w as (select *, source_size * 3 as cap, (row_number() over (order by source nulls last) - 1) % 3 + 1 as w from p),
  r as (select *, cast(cap as double) / w as ratio from w),
  l as (select *, cast(sum(source_size) over () - sum(cap) over (order by ratio, source nulls last rows unbounded preceding) + cap as double)
      / sum(w) over (order by ratio, source nulls last rows between current row and unbounded following) as level from r),
  c as (select *, max(case when ratio > level then level end) over () as common from l),
  t as (select source, source_size, case when common is null or ratio <= common then cast(cap as double) else w * common end as target from c),
  b as (select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as times from t),
  u as (select s.*, b.source_size, b.target, b.times, b.target - b.times * b.source_size as budget,
      sum(s.size) over (partition by s.source order by s.key, s.i rows unbounded preceding) as upto from s join b on s.source is not distinct from b.source)
select doc_id, size, source_size, target,
  cast(size * (times + case when upto <= budget or upto - budget < budget - (upto - size) then 1 else 0 end) as bigint) as taken from u"""

LINES_SQL = """with d as (select row_number() over () as k, doc_id, source, text, string_split(text, chr(10)) as ls from documents),
  l as (select k, source, unnest(ls) as line, generate_subscripts(ls, 1) as place from d),
  t as (select *, trim(line, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) as body from l),
  bad as (select body from t where length(body) >= 16 group by body having count(distinct coalesce('s' || source, '')) >= 8),
  m as (select t.*, bad.body is not null as gone from t left join bad on bad.body = t.body),
  a as (select k, count(*) as n_lines, count(*) filter (where gone) as n_removed, string_agg(line, chr(10) order by place) filter (where not gone) as rest from m group by 1),
  o as (select d.doc_id, d.source, case when a.n_removed > 0 then coalesce(a.rest, '') else d.text end as text, coalesce(a.n_lines, 0) as n_lines,
      coalesce(a.n_removed, 0) as n_removed from d left join a on a.k = d.k)
select doc_id, source, text, cast(length(text) as bigint) as n_chars, n_lines, n_removed from o"""


SECRETS_SQL = r"""with d as (select row_number() over () as k, doc_id, coalesce(text, '') as t from documents),
  rules as (select * from (values
      (0, 'assign', '(?i)(password|passwd|secret|token|api_?key)["' || chr(39) || ']?\x20*[:=]\x20*["' || chr(39) || ']?([A-Za-z0-9+/_.=-]+)', 2, 6),
      (1, 'access', '(AKIA[A-Z0-9]+)', 1, 20), (2, 'hex', '([0-9a-f]+)', 1, 24)) r(place, kind, pattern, grp, least)),
  f as (select k, place, kind, least, string_split_regex(t, pattern) as pieces, regexp_extract_all(t, pattern, 0) as found,
      case when grp = 2 then regexp_extract_all(t, pattern, 2) else regexp_extract_all(t, pattern, 1) end as groups from d, rules where regexp_matches(t, pattern)),
  e as (select k, place, kind, least, unnest(pieces) as piece, unnest(found) as hit, unnest(groups) as g, generate_subscripts(pieces, 1) as i from f),
  m as (select *, sum(length(piece) + coalesce(length(hit), 0)) over (partition by k, place order by i) as stop from e),
  s as (select k, place, kind, cast(stop - length(hit) as bigint) as start, cast(stop as bigint) as stop from m where hit is not null and length(g) >= least),
  j as (select k, string_agg(kind || ':' || start || ':' || stop, ',' order by start, place) as spans, count(*) filter (where kind = 'assign') as n_assign,
      count(*) filter (where kind = 'access') as n_access, count(*) filter (where kind = 'hex') as n_hex from s group by k)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
from d left join j on j.k = d.k"""


def codes_sql(rounds: int = vectorcodes.ROUNDS) -> str:
    """A full scan of each codebook by inner products, which are exact on such integers."""
    near = """a{i} as (select v.k, v.p, min(cast(list_dot_product(v.x, v.x) - 2 * list_dot_product(v.x, b.x) + list_dot_product(b.x, b.x) as bigint) * 256 + b.j) as m
    from parts v join b{i} b on b.p = v.p group by 1, 2)"""
    move = """s{j} as (select p, j, i, floor(sum(c) / count(*)) as c from (select v.p, a.m % 256 as j, unnest(v.x) as c, generate_subscripts(v.x, 1) as i from a{i} a join parts v on v.k = a.k and v.p = a.p) group by 1, 2, 3),
  b{j} as (select b.p, b.j, coalesce(n.x, b.x) as x from b{i} b left join (select p, j, list(c order by i) as x from s{j} group by 1, 2) n on n.p = b.p and n.j = b.j)"""
    steps = ",\n  ".join(x for i in range(rounds) for x in (near.format(i=i), move.format(i=i, j=i + 1)))
    return f"""with finite as (select * from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  v as (select row_number() over (order by vec_id, embedding) as k, vec_id, label, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as e from finite),
  parts as (select k, p, e[p * (len(e) // 4) + 1:(p + 1) * (len(e) // 4)] as x from v, range(4) t(p)),
  b0 as (select p, k - 1 as j, x from parts where k <= 256),
  {steps},
  {near.format(i=rounds)},
  coded as (select k, string_agg(printf('%02x', m % 256), '' order by p) as code, cast(sum(m // 256) as bigint) as error from a{rounds} group by 1),
  named as (select v.vec_id, v.label, c.code, c.error from v join coded c on c.k = v.k),
  books as (select sha256(string_agg(cast(cast(c as bigint) as varchar), ',' order by p, j, i)) as h from (select p, j, unnest(x) as c, generate_subscripts(x, 1) as i from b{rounds}))
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, h as codebooks_sha256 from named, books"""


PHRASES_SQL = r"""with d as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
  p as (select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) as piece from d),
  w as (select row_number() over () as id, lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from p),
  n as (select lang, cast(sum(len(ws)) as bigint) as n from w group by 1),
  g as (select lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) as phrase from w, range(1, 6) r(k) where len(ws) >= k),
  f as (select lang, k, phrase, count(*) as a from g group by 1, 2, 3),
  c as (select lang, k, phrase, a, string_split(phrase, ' ') as ws from f where k > 1 and a >= 100),
  held as (select distinct s.lang, s.phrase from c l, range(1, 5) x(i), range(2, 5) y(size), c s
    where size < l.k and i + size - 1 <= l.k and s.lang = l.lang and s.phrase = array_to_string(l.ws[i:i + size - 1], ' ') and 100 * l.a >= 100 * s.a),
  cuts as (select c.lang, c.phrase, c.a, c.ws, x.k from c anti join held h on h.lang = c.lang and h.phrase = c.phrase join range(1, 5) x(k) on x.k < c.k),
  scores as (select t.lang, t.phrase, t.a, l.a as l, r.a as r, n.n, t.k, cast((cast(1000 as hugeint) * t.a * n.n) // (cast(l.a as hugeint) * r.a) as bigint) as score
    from cuts t join n on n.lang = t.lang join f l on l.lang = t.lang and l.phrase = array_to_string(t.ws[1:t.k], ' ')
    join f r on r.lang = t.lang and r.phrase = array_to_string(t.ws[t.k + 1:], ' ')),
  best as (select * from scores qualify row_number() over (partition by lang, phrase order by score, k) = 1),
  ranked as (select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score from best)
select * from ranked where rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that it can express in full."""
    return {"op3_mixing": MIXING_SQL, "op6_line_dedup": LINES_SQL, "op9_secrets": SECRETS_SQL, "op12_vector_codes": codes_sql(), "op13_phrases": PHRASES_SQL}
