"""Edges of the operators: huge numbers, empty sizes, ids of any kind, special strings, kept files."""

import collections
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stayflow.llm import fingerprints, jaccard_join, mixing, sharding, token_files, topk, urls
from stayflow.llm.queries import URL_RULES
from stayflow.llm.store import new_folder
from tests.llm import cases

LETTERS = public_tokenizers.path("byte_bpe_50k.json")


# ---- exact scores ---------------------------------------------------------------


def test_scores_near_the_end_of_a_long(spark):
    big = 2.0**25  # scaled by 256: 2**33, times 2**28 of the query: 2**61
    rows = [(0, [big, 1.0]), (1, [1.0, big]), (2, [-big, 3.0]), (3, [0.5, 0.5]), (50, [2.0**20, -2.0**10])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").filter("vec_id > 0")
    scaled = {i: [int(256 * x) for x in v] for i, v in rows}
    got = topk.top_k(df, F.col("vec_id") == 50).orderBy("rank").collect()
    want = sorted(((-sum(a * b for a, b in zip(scaled[50], scaled[i])), i) for i in (1, 2, 3)))
    assert [(-r["score"], r["vec_id"]) for r in got] == want
    wide = np.array([[2**40, 2**40]]), np.array([[2**21, 2**21], [2**22, -(2**22)]])
    assert topk.product(*wide).tolist() == [[2**62, 0]]
    with pytest.raises(OverflowError):
        topk.product(np.array([[2**40, 2**40]]), np.array([[2**40, 2**40]]))
    assert topk.product(np.array([[2**40, 2**40]]), np.array([[2**40, 2**40]]), True).tolist() == [[topk.LIMIT]]


# ---- sizes of nothing --------------------------------------------------------------


def test_documents_without_words_come_three_times_at_most(spark):
    rows = [(i, "", "en", "a", 0) for i in range(4)] + [(10, "one two three", "en", "a", 3)]
    rows += [(20 + i, "word " * 50, "en", s, 1) for i, s in enumerate("bbbcccc")]
    mixed = mixing.mix(cases.frame(spark, rows)).collect()
    times = {r["doc_id"]: r["times"] for r in mixed}
    target = {r["source"]: (r["target"], r["source_size"]) for r in mixed}
    assert target["a"][0] == 3 * target["a"][1] and times[10] == 3
    assert max(times.values()) <= 3
    assert mixing.mixed_rows(cases.frame(spark, rows)).count() == sum(times.values())


# ---- ids of any kind -----------------------------------------------------------------


TEXT_IDS = [("b", cases.text(30, 1)), ("a10", cases.text(40, 2)), ("a9", ""), (None, cases.text(20, 3)), ("c", None)]


def test_fingerprints_with_text_ids(spark):
    df = spark.createDataFrame(TEXT_IDS, "doc_id string, text string").repartition(3)
    got = {r["doc_id"]: r for r in fingerprints.compare_with_edits(df).collect()}
    order = ["c", "b", "a9", "a10", None]  # descending, NULL last
    text = dict(TEXT_IDS)
    for i, key in enumerate(order):
        own, after = text[key] or "", text[order[(i + 1) % len(order)]] or ""
        edited = own[: len(own) - len(own) // 2] + after[: len(own) // 2]
        import hashlib

        assert got[key]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()


def test_token_files_with_text_ids(spark):
    folder = new_folder(spark, "tokens")
    token_files.write_tokens(spark.createDataFrame(TEXT_IDS, "doc_id string, text string"), folder, LETTERS)
    got = token_files.read_document_digests(spark, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == ["a10", "a9", "b", "c", None]


# ---- files ------------------------------------------------------------------------------


def test_special_strings_are_what_the_library_makes_of_them(spark):
    texts = ["a<|endoftext|>b", "x  <|endoftext|> y", "<|endoftext|>", "plain text, here.\nAnd there!!"]
    folder = new_folder(spark, "tokens")
    token_files.write_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), folder, LETTERS)
    library = Tokenizer.from_file(LETTERS)
    want = [library.encode(t, add_special_tokens=False).ids + [0] for t in texts]
    assert want[0] == [64, 50256, 65, 0]
    for r in token_files.read_document_digests(spark, folder).collect():
        ids = np.array(want[r["doc_id"]], "<u4")
        assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))


def test_wanted_documents_are_read_by_select(spark, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 300)
    rows = [(i, cases.text(i % 40, i)) for i in range(200)] + [(7, "again"), (None, "no id"), (500, None)]
    folder = new_folder(spark, "tokens")
    token_files.write_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), folder, LETTERS)
    asked = spark.createDataFrame([(3,), (3,), (7,), (199,), (500,), (9999,), (None,)], "doc_id long")
    got = token_files.read_documents(spark, folder, asked).collect()
    starts = {(r["doc_id"], r["start"]): r["n_tokens"] for r in token_files.read_document_digests(spark, folder).collect()}
    library = Tokenizer.from_file(LETTERS)
    want = collections.Counter(
        (i, tuple(library.encode(t or "", add_special_tokens=False).ids + [0])) for i, t in rows if i in {3, 7, 199, 500}
    )
    assert collections.Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    assert all(starts[r["doc_id"], r["start"]] == len(r["ids"]) for r in got)


# ---- rows without an id -------------------------------------------------------------------


def test_near_copies_without_ids_are_no_all_pairs_join(spark):
    base, r = cases.words(80, 5), random.Random(1)
    texts = []
    for i in range(500):
        words = list(base)
        words[r.randrange(80)] = f"x{i}"
        texts.append(" ".join(words))
    found, took = {}, {}
    for name in ("ids", "none", "ids again"):
        rows = [(i if name != "none" else None, t) for i, t in enumerate(texts)]
        began = time.time()
        joined = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
        found[name] = sorted((r["content"], r["n_links"], r["class_content"]) for r in joined.collect())
        took[name] = time.time() - began
    assert found["ids"] == found["none"]
    assert took["none"] < 2 * max(took["ids"], took["ids again"]) + 5


# ---- verdicts ------------------------------------------------------------------------------


def test_model_is_less_certain_of_families_it_has_not_seen(spark, sf_dir):
    """The rules decide by domain and language. A family (one domain and language) that is left out of
    the training is judged with less certainty than when it was there, and verdicts weigh the same."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    host, path = urls.url_parts(F.col("url"))
    family = F.concat(F.regexp_extract("host", "[^.]+$", 0), F.element_at(F.split("path", "/"), 2))
    parts = pages.select(host.alias("host"), path.alias("path")).withColumn(
        "found", urls.fitting_rule(F.col("host"), F.col("path"), URL_RULES)
    )
    known = urls.decided_by_rules(parts).withColumn("family", family).persist()
    certain = lambda df: df.select(F.avg(F.abs(F.col("blocked") - 0.5))).first()[0]
    whole = urls.UrlModel().fit(known)
    sides = {r["verdict"]: r["p"] for r in whole.verdicts(known).groupBy("verdict").agg(F.avg("blocked").alias("p")).collect()}
    assert sides["allow"] < 0.2 and sides["block"] > 0.8
    seen, unseen = [], []
    for name in sorted(r[0] for r in known.select("family").distinct().collect()):
        train, test = known.where(F.col("family") != name), known.where(F.col("family") == name)
        seen.append(certain(whole.verdicts(test)))
        unseen.append(certain(urls.UrlModel().fit(train).verdicts(test)))
    assert sum(unseen) < sum(seen)


# ---- shards -------------------------------------------------------------------------------


def sequential_cut(sizes, shards):
    """Links cut (copies away from the largest part of their group) when groups are placed one after
    the other, each into the shard with most room."""
    total = sum(sizes)
    room = [total // shards + (i < total % shards) for i in range(shards)]
    cut = 0
    for n in sorted(sizes, reverse=True):
        parts = []
        while n:
            i = max(range(shards), key=room.__getitem__)
            part = min(n, room[i])
            room[i] -= part
            n -= part
            parts.append(part)
        cut += sum(parts) - max(parts)
    return cut


def test_cut_links_are_no_more_than_one_by_one(spark):
    r = random.Random(3)
    sizes = [400, 90, 60, *[r.randint(2, 30) for _ in range(60)], *[1] * 700]
    rows, i = [], 0
    for g, n in enumerate(sizes):
        for _ in range(n):
            rows.append((i * 7919 % 100_003, f"text of group {g} {'x' * (g % 5)}"))
            i += 1
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    text, held = dict(rows), collections.defaultdict(collections.Counter)
    counts = collections.Counter(r["shard"] for r in out)
    assert max(counts.values()) - min(counts.values()) <= 1
    for row in out:
        held[text[row["doc_id"]]][row["shard"]] += 1
    cut = sum(sum(c.values()) - max(c.values()) for c in held.values())
    assert cut <= 1.05 * sequential_cut(sizes, 24) + 24
