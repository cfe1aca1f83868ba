"""Registered queries of the numbered operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm.ann import nearest
from claimweave.llm.decontaminate import find_items
from claimweave.llm.language_id import held_out, identify
from claimweave.llm.licences import find_licences
from claimweave.llm.licences import train as train_licences
from claimweave.llm.mixing import Mix
from claimweave.llm.ngram_join import NgramJoin
from claimweave.llm.pii import pseudonymise
from claimweave.llm.pivots import PivotTable
from claimweave.llm.secrets import find_secrets
from claimweave.llm.spelling import count_words, group_variants
from claimweave.llm.substring_dedup import repeated_passages
from claimweave.llm.tables import table
from claimweave.llm.token_counts import count_tokens
from claimweave.llm.whitening import whiten

#: Key of the registered query; a real run takes its own from a secret store.
PII_KEY = "registered query"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


@query
def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "secrets.*")


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found, _ = identify(docs)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


@query
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_items(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("leaks.words", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return found.select(
        "doc_id",
        F.col("leaks.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("leaks.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("leaks.items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = Mix(table(spark, sf_dir, "documents"))
    return mix.taken().select("doc_id", "size", "source_size", "target", "taken")


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    join = NgramJoin(table(spark, sf_dir, "documents"), width=4, percent=85)
    return join.documents().select("doc_id", F.col("n").alias("n_shingles"), "component_id")


@query
def op8_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents"), PII_KEY).select("doc_id", "text", F.size("pii").cast("long").alias("n_replaced"))


@query
def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, ids = repeated_passages(table(spark, sf_dir, "documents"))
    later = ids.select(F.col("row_key"), "doc_id")
    earlier = ids.select(F.col("row_key").alias("other_key"), F.col("doc_id").alias("earlier_doc_id"))
    return found.join(later, "row_key").join(earlier, "other_key").select("doc_id", "earlier_doc_id", F.col("start").alias("start_word"), F.col("end").alias("end_word"))


@query
def op2_licence_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_licences(docs, train_licences(docs))
    families = F.array_join(F.array_sort(F.array_distinct(F.transform("licences", lambda x: x["family"]))), ",")
    return found.select("doc_id", families.alias("families"), F.size("licences").cast("long").alias("n_paragraphs"), F.array_max(F.transform("licences", lambda x: x["probability"])).alias("probability"))


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model, error = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    shares = F.array(*(F.lit(x).cast("double") for x in model.explained)) if model.n else F.array().cast("array<double>")
    each = rows.select("vec_id", F.col("whitened.deviation").alias("deviation"), F.posexplode("whitened.values").alias("at", "value"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"),
        F.col("value").alias("whitened"),
        F.element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(count_words(table(spark, sf_dir, "documents").select("doc_id", "text")))


ORACLE["op12_spelling_variants"] = """
with recursive steps as (
  select list_transform(range(256), lambda n: list_reduce(list_prepend(n::bigint, range(8)),
    lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as step
), run as (
  select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00C0-\u00FF]+')) as r from documents
), counted as (
  select doc_id, r, count(*) as k from run where length(r) >= 6 group by all
), bytes as (
  select r, k, hex(encode(coalesce(doc_id::varchar, '') || ':' || r)) as x from counted
), hashed as (
  select r, k, xor(list_reduce(list_prepend(4294967295::bigint,
      list_transform(range(1, length(x) + 1, 2), lambda i: ('0x' || substr(x, i, 2))::bigint)),
      lambda c, b: xor(c >> 8, step[xor(c & 255, b) + 1])), 4294967295) as h
  from bytes, steps
), word as (
  select case when h % 199 = 0 then substr(r, 1, (h % length(r))::bigint) || substr(r, (h % length(r))::bigint + 2) else r end as w, sum(k)::bigint as n
  from hashed group by 1 having length(w) >= 6 and n >= 5
), cut as (
  select w, n, i, substr(w, 1, i - 1) || substr(w, i + 1) as c
  from (select w, n, unnest(range(1, length(w) + 1)) as i from word)
), pair as (
  select a.w as a, b.w as b from cut a join cut b on a.c = b.c and a.i = b.i and length(a.w) = length(b.w) and a.w <> b.w
  union select c.w, b.w from cut c join word b on c.c = b.w
  union select b.w, c.w from cut c join word b on c.c = b.w
), near as (
  select a.w, a.n, count(*) as n_near, min(struct_pack(less := -b.n, form := encode(b.w))) as best
  from pair p join word a on a.w = p.a join word b on b.w = p.b group by 1, 2
), form as (
  select w, n_near, case when -best.less >= 5 * n then decode(best.form) end as form, case when -best.less >= 5 * n then -best.less end as form_n from near
), chain as (
  select w, form as at from form where form is not null
  union all select c.w, f.form from chain c join form f on f.w = c.at where f.form is not null
), root as (
  select c.w, c.at as root from chain c where not exists (select 1 from form f where f.w = c.at and f.form is not null)
)
select word.w as word, form.form, coalesce(root.root, word.w) as root, word.n, coalesce(n_near, 0)::bigint as n_near, form_n::bigint as form_n
from word left join form using (w) left join root using (w)
"""


@query
def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = PivotTable(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0).top()
    return found.select("query_id", "rank", "vec_id", F.col("score").try_cast("long").alias("score"))


ORACLE["op13_exact_top_k"] = """
with x as (
  select vec_id, list_transform(embedding, lambda c: floor(1024 * c::double)) as v from embeddings
  where len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
), scored as (
  select q.vec_id as query_id, x.vec_id, list_inner_product(q.v, x.v)::bigint as score
  from x q join x on q.vec_id % 100 = 0 and q.vec_id <> x.vec_id
), ranked as (
  select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from scored
)
select * from ranked where rank <= 10
"""
