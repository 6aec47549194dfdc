from collections import Counter

import pytest
from pyspark.sql import functions as F

from stayflow.llm import langid, mixing
from tests.compare import compare
from tests.llm import cases


@pytest.mark.parametrize("rows", [cases.documents(), [], cases.documents()[3:6]], ids=["all", "none", "wordless"])
def test_mix_equals_sql(spark, rows):
    mixed = mixing.mix(cases.frame(spark, rows)).select("doc_id", "size", "source_size", "target", "taken")
    assert compare(cases.duck(rows), mixed, mixing.MIX_SQL) == []


def test_targets_are_shared_by_weight_under_the_cap(spark):
    totals = spark.createDataFrame([("a", 10), ("b", 500), ("c", 1000), ("d", 0)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(totals, (5, 2, 1), 3).collect()}
    # a is full at 30, d at 0; 1480 are left for b and c by 2 and 1.
    assert got["a"] == 30 and got["d"] == 0
    assert got["b"] == pytest.approx(1480 * 2 / 3) and got["c"] == pytest.approx(1480 / 3)


def test_mixed_rows_repeat_whole_rows(spark):
    docs = cases.frame(spark)
    times = Counter()
    for r in mixing.mix(docs).collect():
        times[r["doc_id"], r["source"], r["size"]] += r["times"]
    got = Counter()
    rows = mixing.mixed_rows(docs)
    assert rows.columns == docs.columns
    for r in rows.select("doc_id", "source", mixing.word_count(F.col("text")).alias("w")).collect():
        got[r["doc_id"], r["source"], r["w"]] += 1
    assert got == +times


def test_budgets_are_met_in_a_hot_source(spark):
    rows = [(i, cases.text(i % 17, i), "en", "hot" if i % 3 else f"s{i % 7}", 1) for i in range(600)]
    for source, group in _by_source(mixing.mix(cases.frame(spark, rows)).collect()):
        assert abs(sum(r["taken"] for r in group) - group[0]["target"]) <= 17, source
        assert all(r["taken"] <= 3 * r["size"] for r in group)


def _by_source(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    return groups.items()


def test_bundle_equals_adding_every_ngram():
    texts = ["Ab, a", "", "é x1"]
    got = langid.bundle(texts, langid.np.array([0, 1, 0]), 2, 64, 3)
    want = langid.np.zeros((2, 64))
    for text, group in zip(texts, [0, 1, 0]):
        letters = [0] + [ord(c) if c.isalpha() else 0 for c in text.lower()] + [0]
        letters = [c for i, c in enumerate(letters) if c or i == 0 or letters[i - 1]]
        for x, y, z in zip(letters, letters[1:], letters[2:]):
            if y:
                v = [langid.letter_vector(c, 64, 3).astype(int) for c in (x, y, z)]
                want[group] += langid.np.roll(v[0], 2) * langid.np.roll(v[1], 1) * v[2]
    assert (got == want).all()


def test_languages_of_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    profiles = langid.learn(docs.where(~langid.held_out(F.col("doc_id"))))
    rows = langid.identify(docs, profiles).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert rows and sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_languages_of_awkward_rows(spark):
    docs = cases.frame(spark)
    profiles = langid.learn(docs)
    assert profiles.languages == ("de", "en", "fr")
    got = langid.identify(docs, profiles).collect()
    assert len(got) == docs.count()
    unknown = [r["lang_pred"] for r in got].count("und")
    # NULL, empty, blank, NULL row, digits only.
    assert unknown == 5
    assert all(r["score"] == 0 for r in got if r["lang_pred"] == "und")


def test_no_language_to_learn(spark):
    docs = cases.frame(spark)
    profiles = langid.learn(docs.limit(0))
    assert {r["lang_pred"] for r in langid.identify(docs, profiles).collect()} == {"und"}
