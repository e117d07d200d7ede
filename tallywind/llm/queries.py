"""One query per operator, over its whole table and with production parameters."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tallywind.llm import decontam, hard_negatives, html_layout, langid, lm, ngram_join, packing, paragraph_dedup, pivot_clusters, rules, secrets, suffix_dedup, url_lists
from tallywind.llm.ids import id_remainder
from tallywind.llm.registry import QUERIES, SQL, query, table  # noqa: F401


@query("op1_language_id")
def language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(id_remainder("doc_id", 5) != 0))
    rows = docs.select("doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "text")
    return langid.identify(rows, model).drop("text")


RULES_SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as t from documents),
w as (
  select doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as ls
  from d),
g as (
  select doc_id, list_transform(range(1, len(ws) - 1), lambda i: [ws[i], ws[i + 1], ws[i + 2]]) as gs
  from w),
rep as (
  select doc_id, unnest(gs) as g, generate_subscripts(gs, 1) as i from g),
hit as (
  select doc_id, i, count(*) over (partition by doc_id, g) as n from rep),
cov as (
  select doc_id, count(distinct p) as n_repeat_words
  from (select doc_id, unnest([i, i + 1, i + 2]) as p from hit where n > 1) group by doc_id),
m as (
  select w.doc_id, len(ws) as n_words, cast(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) as bigint) as word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
         len(ls) as n_lines, strlen(t) as n_bytes,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) as n_upper,
         strlen(t) - length(regexp_replace(t, '[^\x00-\x7F]|[A-Za-z]', '', 'g')) as n_letters,
         length(regexp_replace(t, '[^0-9]', '', 'g')) as n_digits,
         len(list_distinct(list_transform(ws, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')))) as n_distinct
  from w left join cov on w.doc_id is not distinct from cov.doc_id),
v as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed
       and 1000 * n_symbols <= 300 * n_words
       and 1000 * n_letters >= 600 * n_bytes
       and 1000 * n_upper <= 400 * n_letters
       and 1000 * n_digits <= 200 * n_bytes
       and 1000 * word_chars between 2500 * n_words and 15000 * n_words
       and 1000 * n_dup_lines <= 500 * n_lines
       and 1000 * n_distinct >= 100 * least(n_words, 1000) as kept
from v
"""


@query("op7_quality_rules", RULES_SQL)
def quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.judge(docs, rules.ordered_rules(docs)).select("doc_id", *rules.BASE, F.col("base_failed"), F.col("kept"))


JOIN_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws
  from documents),
s as (
  select doc_id, list_distinct(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
         else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as ss
  from w),
e as (
  select doc_id, unnest(ss) as x from s),
o as (
  select a.doc_id as a, b.doc_id as b, count(*) as n from e a join e b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2),
l as (
  select o.a, o.b from o join s sa on sa.doc_id = o.a join s sb on sb.doc_id = o.b where 100 * n >= 75 * (len(sa.ss) + len(sb.ss) - n)),
both_ways as (
  select a, b from l union select b, a from l),
r(doc_id, c) as (
  select doc_id, doc_id from s union select t.b, r.c from r join both_ways t on r.doc_id = t.a)
select s.doc_id, len(s.ss) as n_shingles, min(r.c) as component_id from s join r on r.doc_id = s.doc_id group by 1, 2
"""


@query("op3_ngram_jaccard_join", JOIN_SQL)
def ngram_jaccard_join(spark, sf_dir):
    return ngram_join.similarity_groups(table(spark, sf_dir, "documents"))


def vocabulary() -> str:
    """The path of the byte-level BPE vocabulary that ships with the public_tokenizers module."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op2_best_fit_packing")
def best_fit_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_texts(docs, vocabulary())


_ALPHABETS = " ".join(f"when regexp_full_match(core, '[{a.replace('-', chr(92) + '-')}]+') then '{a}'" for a in secrets.ALPHABETS.values())
_TAIL = """case when {z} >= 0 then exp(-{z} * {z} / 2) * 0.3989422804014327 * {poly} else 1 - exp(-{z} * {z} / 2) * 0.3989422804014327 * {poly} end"""
_POLY = "{t} * (0.319381530 + {t} * (-0.356563782 + {t} * (1.781477937 + {t} * (-1.821255978 + {t} * 1.330274429))))"


def _tail(z: str) -> str:
    """SQL of ``secrets.normal_tail``."""
    return _TAIL.format(z=z, poly="(" + _POLY.format(t=f"(1e0 / (1e0 + 0.2316419 * abs({z})))") + ")")


# Either case letter by letter: this engine's own folding goes beyond ASCII.
_KEYS = re.search(r"\(\?i:([^)]*)\)", secrets.ASSIGN)
_EITHER = secrets.ASSIGN.replace(_KEYS[0], "(?:" + "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in _KEYS[1]) + ")")
_QUOTED = {"assign": _EITHER.replace("'", "''"), "access": secrets.ACCESS, "hex": secrets.HEX, "random": secrets.RANDOM}
SECRETS_SQL = rf"""
with d as (
  select doc_id, replace(replace(coalesce(text, ''), chr(57344), chr(57346)), chr(57345), chr(57346)) as t from documents),
k(kind, rank, pattern) as (
  values ('assign', 0, '{_QUOTED["assign"]}'), ('access', 1, '{_QUOTED["access"]}'), ('hex', 2, '{_QUOTED["hex"]}'), ('random', 3, '{_QUOTED["random"]}')),
m as (
  select doc_id, kind, rank, string_split_regex(regexp_replace(t, '(' || pattern || ')', chr(57344) || '\1' || chr(57345), 'g'), '[' || chr(57344) || chr(57345) || ']') as parts
  from d cross join k),
p as (
  select doc_id, kind, rank, unnest(parts) as part, generate_subscripts(parts, 1) as i from m where len(parts) > 1),
q as (
  select *, sum(length(part)) over (partition by doc_id, kind order by i) as stop from p),
sp as (
  select doc_id, kind, rank, part, cast(stop - length(part) as bigint) as start, cast(stop as bigint) as stop from q where i % 2 = 0),
base as (
  select doc_id, kind, rank, start, stop from sp
  where kind in ('access', 'hex') or kind = 'assign' and length(regexp_extract(part, '{_QUOTED["assign"]}', 2)) >= {secrets.ASSIGN_VALUE}),
c as (
  select doc_id, start, stop, regexp_replace(part, '=+', '', 'g') as core from sp
  where kind = 'random' and regexp_matches(part, '[0-9]') and regexp_matches(part, '[A-Za-z]')),
a as (
  select *, case {_ALPHABETS} end as alphabet, string_split(core, '') as ch from c),
b as (
  select *, len(ch) as n, length(alphabet) as k, list_transform(ch, lambda x: instr(alphabet, x)::double) as codes,
         list_transform(ch, lambda x: case when x between '0' and '9' then 1 when x between 'a' and 'z' then 2 when x between 'A' and 'Z' then 3 else 0 end) as kinds,
         list_sum(list_transform(list_distinct(ch), lambda x: pow(length(core) - length(replace(core, x, '')), 2))) as squares
  from a where alphabet is not null and len(ch) > 2),
e as (
  select *, list_sum(codes) / n as mean, list_sum(list_transform(codes, lambda x: (2 * x > k)::double)) as upper,
         list_sum(list_transform(range(1, n), lambda i: ((2 * codes[i] > k) <> (2 * codes[i + 1] > k))::double)) as turns,
         list_sum(list_transform(range(1, n), lambda i: (kinds[i] <> kinds[i + 1] and kinds[i] > 0 and kinds[i + 1] > 0)::double)) as changes
  from b),
f as (
  select *, list_sum(list_transform(codes, lambda x: (x - mean) * (x - mean))) as spread,
         list_sum(list_transform(range(1, n), lambda i: (codes[i] - mean) * (codes[i + 1] - mean))) as carried, 2 * upper * (n - upper) / n + 1 as expected
  from e),
g as (
  select *, (k * squares / n - n - (k - 1)) / sqrt(2e0 * (k - 1) * (n - 1) / n) as z1,
         (turns + 1 - expected) / sqrt(greatest((expected - 1) * (expected - 2) / (n - 1), 1e-6)) as z2,
         case when spread > 0 then (carried / spread + 1e0 / n) * sqrt(n) else 99e0 end as z3,
         (changes - 0.5 - {secrets.TEXT_CHANGES} * (n - 1)) / sqrt({secrets.TEXT_CHANGES * (1 - secrets.TEXT_CHANGES)!r} * (n - 1)) as z4
  from f),
h as (
  select *, greatest(abs(z1), abs(z2), abs(z3)) as z0 from g),
r as (
  select doc_id, start, stop, least(1e0, 6 * ({_tail("z0")})) as p_random, cast(floor(-10 * log10(greatest({_tail("z4")}, 1e-30))) as int) as level,
         cast(floor(log2(n)) as int) as size_class
  from h),
v as (
  select size_class, level, sum(count(*)) over (partition by size_class) as total, sum(count(*)) over (partition by size_class order by level desc) as above
  from r group by 1, 2),
w as (
  select size_class, min(level) as least_level from v where total * pow(10, -level / 10e0) <= {secrets.FDR} * above group by 1),
found as (
  select doc_id, 'random' as kind, 3 as rank, start, stop from r join w using (size_class)
  where p_random >= {secrets.ACCEPT} and level >= least_level
    and not exists (select 1 from base where base.doc_id = r.doc_id and base.start < r.stop and r.start < base.stop)),
al as (
  select * from base union all select * from found),
t as (
  select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank) filter (kind <> 'random') as digest,
         string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank) as spans
  from al group by 1)
select documents.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(digest, '')) as base_sha256, coalesce(spans, '') as spans
from documents left join t on t.doc_id = documents.doc_id
"""


@query("op5_secret_scans", SECRETS_SQL)
def secret_scans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan(docs, secrets.discovery_levels(docs)).drop("text", "secret_spans")


@query("op8_benchmark_decontamination")
def benchmark_decontamination(spark, sf_dir):
    return decontam.held_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_substring_dedup")
def substring_dedup(spark, sf_dir):
    return paragraph_dedup.repeats(table(spark, sf_dir, "documents"))


@query("op4_lm_scoring")
def lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", (id_remainder("doc_id", 7) == 2).alias("held_out"), "text")
    return lm.score_texts(docs, docs.where("not held_out"), ["doc_id", "held_out"])


@query("op6_html_extraction")
def html_extraction(spark, sf_dir):
    return html_layout.extract(table(spark, sf_dir, "pages")).drop("html")


START, DAYS = 1704067200, 90

URL_SQL = rf"""
with p as (
  select page_id, url, {START} + ('0x' || substr(md5(cast(page_id as varchar)), 1, 8))::bigint % ({DAYS} * 86400) as fetched_at,
         regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#:]+)', 1) as host,
         regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://[^/?#]*([^#]*)', 1) as path
  from pages),
n as (
  select distinct host as pattern from p where host <> ''
  union select distinct regexp_extract(host, '[^.]+\.[^.]+\.[^.]+$') from p where regexp_matches(host, '[^.]+\.[^.]+\.[^.]+$')
  union select distinct host || regexp_extract(path, '^/[^/?]*/') from p where regexp_matches(path, '^/[^/?]*/')),
k as (
  select pattern, ('0x' || substr(md5(pattern), 1, 8))::bigint as k from n),
e as (
  select pattern, case when k % 4 = 0 then 'allow' else 'block' end as verdict, {START} + k % 3000000 as since from k where k % 3 = 0
  union all select pattern, 'remove', {START} + k % 3000000 + 1000000 from k where k % 6 = 0
  union all select pattern, 'block', {START} + k % 3000000 + 2000000 from k where k % 30 = 0),
i as (
  select pattern, verdict, since as start, coalesce(lead(since) over (partition by pattern order by since), 1::bigint << 61) as stop from e),
m as (
  select p.page_id, p.fetched_at, i.pattern, i.verdict,
         row_number() over (partition by p.page_id order by length(i.pattern) desc, i.verdict desc, i.pattern desc) as r
  from p join i on i.verdict <> 'remove' and i.start <= p.fetched_at and p.fetched_at < i.stop
   and (case when contains(i.pattern, '/') then starts_with(p.host || p.path, i.pattern)
             or ends_with(p.host, '.' || split_part(i.pattern, '/', 1)) and starts_with(p.path, substr(i.pattern, position('/' in i.pattern)))
        else p.host = i.pattern or ends_with(p.host, '.' || i.pattern) end))
select p.page_id, p.url, p.fetched_at, m.pattern, m.verdict, coalesce(m.verdict = 'block', false) as blocked
from p left join m on m.page_id = p.page_id and m.r = 1
"""


def digits(c):
    """The first 32 bits of a text's md5 as a number."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long")


def captures_and_entries(spark, sf_dir):
    """Captures out of ``pages``, with a fetch time from the page id; and a dated list of their hosts, domains and folders."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.lit(START) + digits(F.col("page_id").cast("string")) % (DAYS * 86400))
    host, path = url_lists.host_of(F.col("url")), url_lists.path_of(F.lower("url"))
    at = pages.select(host.alias("host"), path.alias("path")).where("host is not null")
    domain = F.regexp_extract("host", r"[^.]+\.[^.]+\.[^.]+$", 0)
    folder = F.regexp_extract("path", r"^/[^/?]*/", 0)
    named = F.array("host", domain, F.when(folder != "", F.concat("host", folder)).otherwise(F.lit("")))
    names = at.select(F.explode(named).alias("pattern")).where("pattern <> ''").distinct().withColumn("k", digits(F.col("pattern")))
    added = F.lit(START) + F.col("k") % 3000000
    verdict = F.when(F.col("k") % 4 == 0, "allow").otherwise("block")
    steps = F.array(
        F.struct(verdict.alias("verdict"), added.alias("at"), (F.col("k") % 3 == 0).alias("on")),
        F.struct(F.lit("remove").alias("verdict"), (added + 1000000).alias("at"), (F.col("k") % 6 == 0).alias("on")),
        F.struct(F.lit("block").alias("verdict"), (added + 2000000).alias("at"), (F.col("k") % 30 == 0).alias("on")),
    )
    entries = names.select("pattern", F.explode(steps).alias("s")).where("s.on").select("pattern", "s.verdict", "s.at")
    return captures, entries


@query("op9_url_filters", URL_SQL)
def url_filters(spark, sf_dir):
    captures, entries = captures_and_entries(spark, sf_dir)
    return url_lists.judge(captures, entries)


SUFFIX_SQL = """
with d as (
  select doc_id, encode(coalesce(text, '')) as b from documents),
w as (
  select doc_id, p, b[p:p + 49] as s from (select doc_id, b, unnest(range(1, octet_length(b) - 48)) as p from d where octet_length(b) >= 50)),
m as (
  select s, min(doc_id) as least from w group by s),
r as (
  select doc_id, p from w join m using (s) where least < doc_id),
i as (
  select doc_id, p, sum(opens) over (partition by doc_id order by p) as span
  from (select doc_id, p, case when p - lag(p) over (partition by doc_id order by p) <= 50 then 0 else 1 end as opens from r)),
sp as (
  select doc_id, min(p) as a, max(p) + 50 as z from i group by doc_id, span),
g as (
  select doc_id, coalesce(lag(z) over (partition by doc_id order by a), 1) as a, a as z from sp
  union all select d.doc_id, coalesce(max(sp.z), 1), any_value(octet_length(b)) + 1 from d left join sp on sp.doc_id = d.doc_id group by d.doc_id),
k as (
  select g.doc_id, string_agg(case when g.z > g.a then hex(b[g.a:g.z - 1]) else '' end, '' order by g.a, g.z) as h from g join d on d.doc_id = g.doc_id group by g.doc_id),
n as (
  select doc_id, sum(z - a) as n_removed, count(*) as n_spans from sp group by doc_id)
select d.doc_id, cast(octet_length(b) as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(h)) as kept_sha256
from d join k on k.doc_id = d.doc_id left join n on n.doc_id = d.doc_id
"""


@query("op11_suffix_array_dedup", SUFFIX_SQL)
def suffix_array_dedup(spark, sf_dir):
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


NEGATIVES_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: cast(floor(256e0 * cast(x as double)) as bigint)) as q
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
s as (
  select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same,
         cast(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) as bigint) as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (
  select anchor_id, other as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, other) <= 5)
select p.anchor_id, positive_id, cast(row_number() over (partition by p.anchor_id, positive_id order by score desc, other) as int) as rank,
       other as negative_id, positive_score, score as negative_score
from p join s on s.anchor_id = p.anchor_id and not same and 80 * positive_score <= 100 * score and score <= positive_score
qualify row_number() over (partition by p.anchor_id, positive_id order by score desc, other) <= 5
"""


@query("op12_hard_negative_mining", NEGATIVES_SQL)
def hard_negative_mining(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def _round_sql(k: int) -> str:
    """One assignment of every vector and the centroids that follow from it."""
    return f"""a{k} as (
  select vec_id, any_value(v.q) as q, min(16 * list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) + c.c) as best
  from v cross join c{k} c group by vec_id),
m{k} as (
  select c, i, (s - (s % n + n) % n) // n as x
  from (select c, i, sum(x) as s, count(*) as n from (select best % 16 as c, unnest(q) as x, generate_subscripts(q, 1) as i from a{k}) group by c, i)),
c{k + 1} as (
  select c.c, coalesce(n.q, c.q) as q from c{k} c left join (select c, list(cast(x as bigint) order by i) as q from m{k} group by c) n on n.c = c.c)"""


CLUSTERS_SQL = f"""
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64e0 * cast(x as double)) as bigint)) as q
  from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
c0 as (
  select row_number() over (order by sha256('1:' || vec_id)) - 1 as c, q from v order by sha256('1:' || vec_id) limit 16),
{", ".join(_round_sql(k) for k in range(4))},
f as (
  select vec_id, cast(best % 16 as int) as cluster, cast(best // 16 as bigint) as distance from a3)
select vec_id, cluster, distance, cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia, cast(sum(distance) over () as bigint) as inertia,
       sha256(array_to_string(c3.q, ',')) as centroid_sha256
from f join c3 on c3.c = f.cluster
"""


@query("op13_centroid_clustering", CLUSTERS_SQL)
def centroid_clustering(spark, sf_dir):
    return pivot_clusters.clusters_with_inertia(table(spark, sf_dir, "embeddings"))


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline  # at the top of the repository; it takes its vocabulary from here

    return corpus_pipeline.run(spark, sf_dir)
