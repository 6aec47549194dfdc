from collections import Counter

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from stayflow.llm import bpe, langid, mixing
from stayflow.llm.store import new_folder
from tests.llm import cases
from tests.llm.test_similarity import joined_by_force, shingle_words


def stages(spark, docs):
    """What each stage gives, written and read again."""
    out = []
    for name, stage in corpus_pipeline.STAGES:
        folder = new_folder(spark, f"test-{name}")
        stage(spark, docs, "").write.parquet(folder)
        docs = spark.read.parquet(folder)
        out.append(docs)
    return out


def test_stages_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    extra = [(10_000, "12 34", "en", "src0", 5), (10_001, None, "en", "src0", 0), (10_002, "", "en", "src1", 0)]
    docs = spark.createDataFrame(rows + extra, docs.schema)
    kept, single, mixed, encoded = stages(spark, docs)
    columns = docs.columns
    assert kept.columns == single.columns == mixed.columns == columns

    # Language: all that has letters stays.
    want = [r for r in rows if any(map(str.isalpha, r[1] or ""))]
    assert cases.plain(kept.collect()) == cases.plain(want)

    # Near duplicates: the least id of each class.
    ids = {c for _, c, *_ in joined_by_force(want)}
    want = [r for r in want if r[0] in ids]
    assert cases.plain(single.collect()) == cases.plain(want)

    # Mix: as often as the SQL says.
    con = cases.duck(want)
    taken = con.execute(f"SELECT doc_id, size, taken FROM ({mixing.MIX_SQL})").fetchall()
    times = {d: n // size for d, size, n in taken if size}
    got = Counter(r["doc_id"] for r in mixed.collect())
    assert got == Counter({d: n for d, n in times.items() if n})
    assert {tuple(r) for r in mixed.collect()} <= set(want)

    # Encoding.
    ranks = bpe.parse_ranks(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    library = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = {r[0]: r[1] for r in want}
    for r in encoded.collect():
        assert list(r["ids"]) == library.encode_ordinary(text[r["doc_id"]]) and r["restored"]
    assert encoded.count() == mixed.count()


def test_run_over_a_table(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "ids", "n_tokens", "restored"]
    assert got.where(~F.col("restored")).count() == 0 and got.count() > 0


def test_awkward_rows_pass_every_stage(spark):
    docs = cases.frame(spark)
    kept, single, mixed, encoded = stages(spark, docs)
    assert kept.columns == docs.columns and single.columns == docs.columns and mixed.columns == docs.columns
    assert kept.count() == sum(any(map(str.isalpha, r[1] or "")) for r in cases.documents())
    ids = [r["doc_id"] for r in single.collect()]
    assert len(ids) == len({shingle_words(r[1]) for r in cases.documents() if any(map(str.isalpha, r[1] or ""))}) - 1
    assert encoded.count() == mixed.count()


def test_an_empty_table_stays_empty(spark):
    assert [s.count() for s in stages(spark, cases.frame(spark, []))] == [0, 0, 0, 0]


def test_a_long_text_like_no_language_goes_and_short_ones_stay(spark):
    rows = [(i, cases.text(60, i), "en", "a", 1) for i in range(20)]
    rows += [(100, " ".join("qxzkqvjx"[i % 8 :] for i in range(90)), None, "a", 1), (101, "Qx.", None, "a", 1)]
    docs = cases.frame(spark, rows)
    ids = {r["doc_id"] for r in corpus_pipeline.language(spark, docs, "").collect()}
    assert 100 not in ids and {101, *range(20)} <= ids
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert langid.learn(unlabelled).languages == ()
    assert corpus_pipeline.language(spark, unlabelled, "").count() == len(rows)
