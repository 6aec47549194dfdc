"""Registered queries of the corpus operators; each reads its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.llm import (
    alignment,
    bpe,
    fingerprints,
    jaccard_join,
    langid,
    mixing,
    ranked_search,
    sharding,
    substring_dedup,
    token_counts,
    token_files,
    topk,
    urls,
)
from stayflow.llm.store import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def add(run):
        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = check
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


@query("op1_phrase_fingerprint")
def phrase_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op2_token_files")
def token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), folder, vocabulary)
    return token_files.read_document_digests(spark, folder)


@query("op3_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(docs, vocabulary, public_tokenizers.PATTERN)


@query("op4_jaccard_join")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard_join.jaccard_join(table(spark, sf_dir, "documents", "doc_id", "text"))
    return joined.select("doc_id", "class_id", "n_links", "copies")


@query("op5_shards")
def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op6_edit_counts")
def edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three edits of each document: its source is put before it, seven characters after its first
    third give way to its first nine, and its language is put after it."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    text, n = F.coalesce("text", F.lit("")), F.coalesce(F.length("text"), F.lit(0))
    put = F.concat(F.coalesce("source", F.lit("")), F.lit(" "))
    edit = lambda seq, start, removed, inserted: F.struct(
        F.lit(seq).alias("seq"), start.alias("start"), F.lit(removed).alias("removed"), inserted.alias("inserted")
    )
    changes = F.array(
        edit(1, F.lit(0), 0, put),
        edit(2, F.length(put) + F.floor(n / 3).cast("int"), 7, F.substring(text, 1, 9)),
        edit(3, F.length(put) + n + 9, 0, F.concat(F.lit(" "), F.coalesce("lang", F.lit("")))),
    )
    edits = docs.select("doc_id", F.explode(changes).alias("c")).select("doc_id", "c.*")
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    counts = token_counts.recount(docs.select("doc_id", "text"), edits, vocabulary, public_tokenizers.PATTERN)
    return counts.select(
        "doc_id", "n_chars", "n_tokens", "edits", "edited_chars", "edited_tokens", "encoded_chars",
        F.sha2("edited_text", 256).alias("edited_sha256"), F.size("leaf_tokens").cast("long").alias("leaves"),
    )


#: The rules of the url query, fixed by its contract.
URL_RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]


@query("op7_url_filter")
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)


@query("op8_source_mix", mixing.MIX_SQL)
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


TOP_K_SQL = """
WITH scaled AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM scaled q JOIN scaled c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op9_top_k", TOP_K_SQL)
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0)


@query("op10_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    profiles = langid.learn(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.identify(docs, profiles)


REPEATS_SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, s, array_to_string(list_slice(w, s, s + 19), ' ') AS passage
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM split WHERE len(w) >= 20)),
later AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, row_number() OVER (PARTITION BY passage ORDER BY doc_id, s) AS n FROM windows)
  WHERE n > 1),
removed AS (SELECT DISTINCT doc_id, s + o AS place FROM later, range(20) AS t(o)),
kept AS (
  SELECT u.doc_id, string_agg(u.word, ' ' ORDER BY u.place) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM split) u
  ANTI JOIN removed r ON r.doc_id = u.doc_id AND r.place = u.place
  GROUP BY u.doc_id)
SELECT s.doc_id, len(s.w) AS n_words, len(s.w) - coalesce(k.n, 0) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON k.doc_id = s.doc_id
"""


@query("op11_substring_dedup", REPEATS_SQL)
def substring_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op12_token_alignment")
def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    letters, pieces = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.digests(docs, letters, pieces)


RANKED_SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
sizes AS (SELECT doc_id, len(w)::BIGINT AS n FROM split WHERE len(w) > 0),
totals AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM sizes),
tfs AS (
  SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(w) AS term FROM split) GROUP BY ALL),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE text IS NOT NULL),
dfs AS (SELECT term, count(*)::BIGINT AS df FROM tfs WHERE term IN (SELECT term FROM asked) GROUP BY term),
weights AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight FROM dfs, totals),
parts AS (
  SELECT t.doc_id, t.term, w.weight * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (10 + (90 * s.n * big_n) // big_l))) AS part
  FROM tfs t JOIN sizes s USING (doc_id) JOIN weights w USING (term), totals),
scores AS (
  SELECT a.item_id, p.doc_id, sum(p.part)::BIGINT AS score FROM asked a JOIN parts p USING (term) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""


@query("op13_ranked_search", RANKED_SQL)
def ranked_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return ranked_search.search(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
