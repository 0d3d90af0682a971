"""Queries that apply the corpus operators to whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import (
    decontamination, exact_dedup, hard_negatives, language, line_dedup, mixing, near_dedup, packing, quality, spelling, suffix_dedup, url_filter, warc_archive,
)
from tabloom.scratch import materialize, new_path


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf, "documents"), keep="max")


def op2_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = language.fit_language(language.teaching_spans(docs.where(language.learns(F.col("doc_id")))))
    found = language.identify(docs.select("doc_id", "text"), model, passages=False)
    return found.select("row.doc_id", quality.held_out(F.col("row.doc_id")).alias("held_out"), F.col("found.lang").alias("lang_pred"), "found.score")


def op3_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op4_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    judged = url_filter.filter_urls(table(spark, sf, "pages").select("page_id", "url"), url_filter.rules_table(spark))
    return judged.select("row.page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict")


def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    stats = quality.with_statistics(table(spark, sf, "documents").select("doc_id", "text")).select(F.col("row.doc_id").alias("id"), "stats")
    stats = materialize(stats, "quality-stats")
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    model = quality.fit_quality(stats, labels.where(~quality.held_out(F.col("id"))))
    scored = stats.select(F.col("id").alias("doc_id"), quality.held_out(F.col("id")).alias("held_out"), model.score(F.col("stats")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.KEEP_FROM).cast("int"))


def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source")
    mixed = mixing.mix(docs, mixing.tempered_weights(docs))
    return mixed.select("row.doc_id", "row.source", "mixed.*")


def op7_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf, "documents"), window=50, with_kept=False)


def op8_warc_archive(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc_archive.write_archive(table(spark, sf, "pages"), path, min_bytes=0)
    return warc_archive.read_facts(spark, path)


def op9_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf, "documents"), width=2)


def op10_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf, "documents"))


def op11_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.spelling_groups(spelling.counted_words(table(spark, sf, "documents").select("doc_id", "text")))


def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", label), F.col("id") % 100 == 0)


def op13_sequence_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf, "documents"), tokenizer_path("byte_bpe_50k.json"))
    pieces = materialize(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "packing-pieces")
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_language": op2_language,
    "op3_decontamination": op3_decontamination,
    "op4_url_filter": op4_url_filter,
    "op5_quality": op5_quality,
    "op6_mixing": op6_mixing,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_warc_archive": op8_warc_archive,
    "op9_near_dedup": op9_near_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_sequence_packing": op13_sequence_packing,
}

def spelling_sql() -> str:
    """The checksum goes bit by bit over the bytes of the run behind its id; near words share a word with one character less at one place."""
    bits = "list_reduce(list_prepend(4294967295::ubigint, steps), lambda c, b: case when b < 256 then xor(c, b) else xor(c >> 1, (c & 1) * 3988292384::ubigint) end)"
    return rf"""
with runs as (
  select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents),
kinds as (select doc_id, run, count(*) as times from runs where length(run) >= 5 group by all),
coded as (
  select doc_id, run, times, list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''), lambda c: unicode(c)) as points from kinds),
bytes as (
  select doc_id, run, times,
    flatten(list_transform(points, lambda p: case when p < 128 then [p] else [192 + (p >> 6), 128 + (p & 63)] end)) as b from coded),
summed as (
  select doc_id, run, times, flatten(list_transform(b, lambda x: [x::ubigint, 256, 256, 256, 256, 256, 256, 256, 256])) as steps from bytes),
hashed as (select doc_id, run, times, xor({bits}, 4294967295::ubigint) as h from summed),
altered as (
  select case when doc_id is not null and h % 97 = 0 then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2) else run end as word, times from hashed),
words as (select word, sum(times)::bigint as n from altered where length(word) >= 5 group by word having sum(times) >= 3),
cut as (select word, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from (select word, unnest(range(1, length(word) + 1)) as i from words)),
near as (
  select a.word, b.word as other from cut a join cut b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select a.word, a.rest from cut a join words w on w.word = a.rest
  union select a.rest, a.word from cut a join words w on w.word = a.rest),
ranked as (
  select near.word, count(*) over (partition by near.word) as n_near, other, o.n as m,
    row_number() over (partition by near.word order by o.n desc, encode(other)) as place
  from near join words o on o.word = other),
forms as (
  select words.word, words.n, coalesce(n_near, 0) as n_near, case when m >= 2 * words.n then other end as form, case when m >= 2 * words.n then m end as form_n
  from words left join ranked on ranked.word = words.word and place = 1),
recursive_roots as (
  with recursive up(word, root) as (select word, word from forms union select up.word, forms.form from up join forms on forms.word = up.root and forms.form is not null)
  select up.word, root from up join forms on forms.word = root where forms.form is null)
select word, form, root, n, n_near, form_n from forms join recursive_roots using (word)"""


SQL = {
    "op1_exact_dedup": """
select doc_id, max(doc_id) over (partition by coalesce(text, '')) as keep_id,
       count(*) over (partition by coalesce(text, '')) as group_size,
       doc_id = max(doc_id) over (partition by coalesce(text, '')) as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents""",
    "op3_decontamination": r"""
with t as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') as h from documents),
b as (select item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') as g from benchmark),
tw as (select doc_id, len(h) as size, unnest(h) as word, unnest(range(len(h))) as p from t),
bw as (select item_id, len(g) as n, least(13, len(g)) as w, unnest(g) as word, unnest(range(len(g))) as q from b),
m as (select doc_id, item_id, size, n, w, p - q as shift, q from tw join bw using (word)),
f as (select *, count(*) over frame as equal, min(q) over frame as first from m
      window frame as (partition by doc_id, item_id, shift order by q range between w - 1 preceding and current row))
select doc_id, item_id, max(equal / w) as best, cast(min(greatest(shift, 0)) as integer) as at from f
where equal >= ceil(round(w * 0.8, 9)) and greatest(0, -shift, q - w + 1) <= least(first, n - w, size - shift - w)
group by doc_id, item_id""",
    "op4_url_filter": r"""
with rules(r_host, r_path, action) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
rests as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
parts as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from rests),
fits as (
  select page_id, max_by(r_host || r_path, length(r_host || r_path)) as rule, max_by(action, length(r_host || r_path)) as action
  from parts join rules on (host = r_host or ends_with(host, '.' || r_host)) and starts_with(path, r_path)
  group by page_id)
select page_id, host, path, rule, coalesce(action, 'allow') as verdict from parts left join fits using (page_id)""",
    "op8_warc_archive": """
with d as (select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as h from pages),
r as (select *, max(page_id) over (partition by payload) as response from d)
select page_id, strlen(payload) as payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         cast((cast('0x' || substr(h, 1 + 10 * (i // 8), 10) as bigint) >> (35 - 5 * (i % 8))) & 31 as integer) + 1, 1) for i in range(32)], '') as payload_digest,
       case when page_id = response then 'response' else 'revisit' end as record_type,
       case when page_id <> response then response end as refers_to
from r""",
    "op9_near_dedup": r"""
with recursive t as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
s as (select distinct doc_id, unnest(case when len(w) < 2 then w else [w[i] || ' ' || w[i + 1] for i in range(1, len(w))] end) as g from t),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
e as (select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * c >= 80 * (nx.n + ny.n - c)),
two as (select x, y from e union all select y, x from e),
reach(doc_id, other) as (select doc_id, doc_id from documents union select reach.doc_id, two.y from reach join two on other = two.x),
c as (select doc_id, min(other) as component_id from reach group by doc_id)
select doc_id, coalesce(n.n, 0) as n_shingles, component_id, doc_id = component_id as kept from c left join n using (doc_id)""",
    "op11_spelling_variants": spelling_sql(),
    "op12_hard_negatives": """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings where vec_id is not null and label is not null and embedding is not null and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))),
s as (
  select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, cast(list_dot_product(a.v, b.v) as bigint) as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (
  select anchor_id, id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select anchor_id, positive_id, cast(row_number() over w as integer) as rank, id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id) where not same and 80 * positive_score <= 100 * score and score <= positive_score
window w as (partition by anchor_id, positive_id order by score desc, id)
qualify row_number() over w <= 5""",
}
