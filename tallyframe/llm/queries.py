"""One query for each operator over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import decontam, jaccard, packing, pseudonyms, sharding, spans, tokencount, topk, toxicity, urlfilter

PSEUDONYM_KEY = "tallyframe"  # for tests and trials: who knows the key can undo the pseudonyms
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def tokenizer_file(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pseudonym_key(spark: SparkSession) -> str:
    """The secret key of the pseudonyms, from the session's setting spark.tallyframe.pseudonymKey."""
    return spark.conf.get("spark.tallyframe.pseudonymKey", PSEUDONYM_KEY)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.exact_topk(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.section_tokens(_table(spark, sf_dir, "documents"), tokenizer_file())


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    out = toxicity.held_out(F.col("doc_id"))
    model = toxicity.train(documents.filter(~out), labels.filter(~out))
    found = toxicity.score(documents, model)
    return found.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_sets(_table(spark, sf_dir, "documents"), words=3, percent=90)


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(_table(spark, sf_dir, "documents"), pseudonym_key(spark), count_col="n_changed")


def op7_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_file())


def op9_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"), 16)


def op10_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_exact_topk, op2_url_filter, op3_token_counts, op4_toxicity, op5_ngram_jaccard, op6_pseudonyms, op7_sentence_spans, op8_best_fit_packing, op9_sampled_splitters, op10_spaced_seeds)
}

ORACLES: dict[str, str] = {
    "op1_exact_topk": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
            where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), s as (
            select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
            from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id
        ), r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
        select query_id, rank, vec_id, score from r where rank <= 10""",
    "op2_url_filter": """
        with u as (
            select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages
        ), h as (
            select page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u
        ), r as (
            select *, case
                when (host = 'www.example.com' or host like '%.www.example.com') and path like '/en/%' then 'www.example.com/en/'
                when (host = 'example.com' or host like '%.example.com') and path like '/en/%' then 'example.com/en/'
                when (host = 'net' or host like '%.net') and path like '/es/%' then 'net/es/'
                when (host = 'net' or host like '%.net') and path like '/fr/%' then 'net/fr/'
                when (host = 'com' or host like '%.com') and path like '/%' then 'com/' end as rule
            from h
        )
        select page_id, host, path, rule, case when rule in ('example.com/en/', 'net/es/', 'net/fr/') then 'block' else 'allow' end as verdict from r""",
}
