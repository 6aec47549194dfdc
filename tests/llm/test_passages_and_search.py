"""Passages that repeat, tokens of two tokenizers side by side, and ranked search."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stayflow.llm import alignment, ranked_search, substring_dedup
from stayflow.llm.fm_index import FMIndex, WaveletTree
from tests.llm import cases

LETTERS = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


# ---- repeated passages ------------------------------------------------------


def test_wavelet_tree_counts():
    r = np.random.default_rng(1)
    for n, kinds in ((1, 1), (64, 2), (1000, 37), (129, 300)):
        symbols = r.integers(0, kinds, n)
        tree = WaveletTree(symbols, kinds)
        asked, at = r.integers(0, kinds, 500), r.integers(0, n + 1, 500)
        assert tree.rank(asked, at).tolist() == [int((symbols[:p] == c).sum()) for c, p in zip(asked, at)]


@pytest.mark.parametrize("length", [2, 3, 5, 20])
def test_matching_statistics_equal_all_places(length):
    r = np.random.default_rng(length)
    parts = [r.integers(1, 4, r.integers(length, 4 * length)) for _ in range(30)]
    text = np.concatenate([np.append(p, 0) for p in parts])
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = ends - [len(p) for p in parts]
    index, seen = FMIndex(text, length), {}
    for a, b in zip(starts, ends):
        for i in range(a, b - length + 1):
            seen.setdefault(tuple(text[i : i + length]), []).append(i)
    met = 0
    for places, low, high in index.matching_statistics(text, starts, ends):
        first = index.first[index.interval(low)]
        for place, n, least in zip(places, high - low, first):
            found = seen[tuple(text[place : place + length])]
            assert (n, least) == (len(found), found[0])
            met += 1
    assert met == sum(map(len, seen.values()))


def without_repeats(rows, window, hashes):
    """(id, text) to (words, removed, kept) by a table of all windows."""
    seen, out = set(), {}
    for key in sorted(set(rows), key=lambda k: (k[0] is None, k[0] or 0, hashes[k[1] or ""])):
        words = re.findall(r"[^\x20\x09-\x0D]+", key[1] or "")
        stays = [True] * len(words)
        for i in range(len(words) - window + 1):
            passage = tuple(words[i : i + window])
            if passage in seen:
                stays[i : i + window] = [False] * window
            seen.add(passage)
        out[key] = (len(words), len(words) - sum(stays), " ".join(w for w, s in zip(words, stays) if s))
    return out


def compare_repeats(spark, df, rows, window):
    texts = spark.createDataFrame(sorted({(t or "",) for _, t in rows}), "t string")
    hashes = dict(texts.select("t", F.xxhash64("t")).collect())
    want = without_repeats(rows, window, hashes)
    got = substring_dedup.remove_repeats(df, window)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept"]
    assert cases.plain(got.collect()) == cases.plain([(k[0], *want[k]) for k in rows])


def test_repeats_of_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in cases.documents()]
    compare_repeats(spark, cases.frame(spark), rows, 20)
    assert substring_dedup.remove_repeats(cases.frame(spark, []), 20).collect() == []


@pytest.mark.parametrize("window", [1, 3, 6, 20])
def test_repeats_equal_brute_force(spark, window, monkeypatch):
    r = random.Random(window)
    base = [cases.words(r.randint(0, 90), i) for i in range(25)]
    rows = []
    for i in range(120):
        words = list(r.choice(base))
        for _ in range(r.randint(0, 3)):
            at = r.randint(0, len(words))
            words[at:at] = r.choice(base)[: r.randint(1, 60)] if r.random() < 0.5 else [str(i)]
        rows.append((i * 7 % 120, r.choice([" ", "\n", " \t"]).join(words)))
    rows += [(1000, "same " * 5000), (1001, "x y " * 300), (1002, " ".join(cases.words(100, 1)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    compare_repeats(spark, df, rows, window)
    # The same where every gram counts as hot, so that all windows go by their whole hash.
    frequent = substring_dedup.frequent
    monkeypatch.setattr(substring_dedup, "frequent", lambda docs, window, shards: frequent(docs, window, 10**9))
    compare_repeats(spark, df, rows, window)


def test_hot_grams_are_found(spark):
    line = " ".join(cases.words(12, 77))
    rows = [(i, f"{cases.text(30, i + 100)} {line} {cases.text(30, i + 900)}") for i in range(300)]
    df = spark.createDataFrame(rows, "place long, text string").withColumn("digest", F.lit(0).cast("long"))
    hot = substring_dedup.frequent(df.repartition(4), 20, 100)
    assert 1 <= len(hot) <= 20
    assert len(substring_dedup.frequent(df, 20, 2)) == 0


def test_ids_of_any_kind(spark):
    rows = [("b", cases.text(30, 1)), ("a10", cases.text(30, 1)), ("a9", cases.text(40, 1)), (None, cases.text(30, 1))]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(df).collect()}
    same = cases.text(40, 1).startswith(cases.text(30, 1))
    assert got == {"a10": 0, "a9": 30 if same else 0, "b": 30, None: 30}


# ---- two tokenizers ---------------------------------------------------------


def test_gallop_equals_plain_search():
    r = np.random.default_rng(3)
    for n, m in ((0, 5), (5, 0), (1, 1), (40, 1000), (1000, 1200), (333, 50_000)):
        short, long = (np.sort(r.choice(60_000, k, replace=False)) for k in (n, m))
        assert alignment.gallop(short, long).tolist() == np.searchsorted(long, short).tolist()


def aligned_by_hand(texts):
    """For each text (n_a, n_b, groups, links), or None without tokens."""
    first = Tokenizer.from_file(LETTERS)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    with open(LETTERS, encoding="utf-8") as file:
        a_bytes, b_bytes = alignment.letter_tokens(file.read()), alignment.piece_tokens(second)
    out = []
    for text in texts:
        a, b = (first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes[i] for i in a) != whole or b"".join(b_bytes[i] for i in b) != whole:
            out.append(None)
            continue
        ends, end = {}, 0
        for n, i in enumerate(a):
            end += len(a_bytes[i])
            ends[end] = n
        groups, links, end, at_a, at_b = [], [], 0, 0, 0
        for n, i in enumerate(b):
            end += len(b_bytes[i])
            if end in ends:
                stop = ends[end] + 1
                groups.append(",".join(map(str, a[at_a:stop])) + "|" + ",".join(map(str, b[at_b : n + 1])))
                links.append((a[stop - 1], i))
                at_a, at_b = stop, n + 1
        out.append((len(a), len(b), groups, links))
    return out


ODD = ["<|endoftext|> a<s>b", "  two  spaces \n x", " lead", "trail  ", "a▁b", "\x00nul", "\n\n  \t", "x" * 3000,
       "a b", "<0x41> q", " ", "ﬁ é é", "a\n b", "it's 12,345.67 -- don't", "\r\n\x1c \x85", "👩‍👩‍👧 ok"]


def test_alignment_equals_the_libraries(spark, sf_dir):
    r = random.Random(4)
    parts = [" ", "  ", "\n", "the", "Ing", "é", "漢", "▁", "1", ".", "'s", "\t", "\x1c", "<s>", "😀"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 12)))) for i in range(2000)]
    rows += [(None, t) for t in ODD] + [(d[0], d[1]) for d in cases.documents()] + [(5000, None)]
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows += [tuple(x) for x in given.collect()]
    found = aligned_by_hand([t for _, t in rows])
    count = collections.Counter(link for f in found if f for link in f[3])
    best = collections.Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    want = []
    for (i, _), f in zip(rows, found):
        if f is None:
            want.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        top = sum(count[x] == best[x[1]] for x in links)
        want.append((i, n_a, n_b, len(groups), len(links), top, sum(count[x] for x in links), digest))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("links", F.lit(1)).repartition(3)
    got = alignment.digests(df, LETTERS, PIECES)
    assert cases.plain(got.collect()) == cases.plain(want)


def test_pair_counts_are_bounded_and_empty_tables(spark):
    pairs = alignment.Alignment(spark, LETTERS, PIECES)
    aligned = pairs.align(cases.frame(spark))
    counts = pairs.pair_counts(aligned)
    assert counts.agg(F.sum("links")).first()[0] == aligned.agg(F.sum("n_groups")).first()[0]
    assert counts.groupBy("a", "b").count().where("count > 1").count() == 0
    empty = cases.frame(spark, [])
    assert alignment.digests(empty, LETTERS, PIECES).collect() == []
    assert pairs.pair_counts(pairs.align(empty)).collect() == []


def test_little_memory_gives_the_same(monkeypatch):
    monkeypatch.setattr(alignment, "MAX_CHUNKS", 20)
    with open(LETTERS, encoding="utf-8") as a, open(PIECES, "rb") as b:
        aligner = alignment.Aligner(a.read(), b.read())
    texts = [cases.text(40, i % 7) + "x" * (i * 3) for i in range(60)]
    want = [";".join(f[2]) for f in aligned_by_hand(texts)]
    assert [g for t in texts for g in aligner.align([t]).column("groups").to_pylist()] == want


# ---- ranked search ----------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def ranked_by_hand(docs, items, k=10):
    terms = lambda t: TERM.findall((t or "").translate(SMALL))
    split = [(i, terms(t)) for i, t in docs]
    split = [(i, t) for i, t in split if t]
    n_all, n_terms = len(split), sum(len(t) for _, t in split)
    df, held = collections.Counter(), collections.defaultdict(list)
    for row, (_, t) in enumerate(split):
        m = 100 - 90 + (90 * len(t) * n_all) // n_terms
        for term, tf in collections.Counter(t).items():
            df[term] += 1
            held[term].append((row, (10**9 * tf) // (1000 * tf + 8 * m)))
    out = []
    for item, text in items:
        scores = collections.Counter()
        for term in set(terms(text)):
            weight = math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[term] + 1)))
            for row, part in held[term]:
                scores[row] += weight * part
        line = sorted((-s, split[row][0] is None, split[row][0] or 0) for row, s in scores.items() if s > 0)
        out += [(item, n, None if none else i, -s) for n, (s, none, i) in enumerate(line[:k], 1)]
    return out


def compare_search(spark, docs, items, frame=None, k=10):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4) if frame is None else frame
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("x"))
    got = ranked_search.search(frame, asked, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert cases.plain(got.collect()) == cases.plain(ranked_by_hand(docs, items, k))


ITEMS = [(1, cases.text(30, 1)), (2, "WORD word 12 Word"), (3, None), (4, ""), (None, cases.text(20, 3)),
         (5, " .,! "), (6, cases.text(3000, 2)), (1, "ÜNÏ ünï 漢字"), (7, "nowhere")]


def test_search_of_awkward_rows(spark, monkeypatch):
    rows = [(d[0], d[1]) for d in cases.documents()]
    compare_search(spark, rows, ITEMS, cases.frame(spark))
    monkeypatch.setattr(ranked_search, "BLOCK_CHARS", 150)
    compare_search(spark, rows, ITEMS, cases.frame(spark))


def test_search_of_empty_tables(spark):
    compare_search(spark, [], ITEMS, cases.frame(spark, []))
    compare_search(spark, [(1, "a b")], [])
    compare_search(spark, [(1, None), (2, " ")], ITEMS)


def test_search_equals_brute_force(spark, monkeypatch):
    r = random.Random(6)
    docs = [(i, cases.text(r.randint(0, 60), r.randint(0, 400))) for i in range(700)]
    items = [(i, cases.text(r.randint(1, 25), 1000 + i)) for i in range(150)] + [(900, docs[5][1]), (901, docs[5][1])]
    monkeypatch.setattr(ranked_search, "TREE_DOCS", 100)
    compare_search(spark, docs, items)
    compare_search(spark, docs, items, k=3)


def test_search_with_text_ids(spark):
    docs = [("b", "one two"), ("a", "one two"), ("c", "three")]
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    got = ranked_search.search(spark.createDataFrame(docs, "doc_id string, text string"), items)
    assert [(r["rank"], r.doc_id) for r in got.orderBy("rank").collect()] == [(1, "a"), (2, "b")]


def test_node_pairs_are_pruned():
    """Documents of a hundred subjects with words of their own: most leaves are never scored."""
    r = random.Random(8)
    subject = [[f"s{s}w{w}" for w in range(30)] for s in range(100)]
    texts = [[r.choice(subject[i % 100]) for _ in range(40)] for i in range(3200)]
    known = {w: n for n, w in enumerate(sorted({w for s in subject for w in s}))}
    sets = [collections.Counter(known[w] for w in t) for t in texts]
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    term, tf = np.array([x for s in sets for x in sorted(s.items())]).T
    docs = ranked_search.Documents(np.arange(len(sets)), np.full(len(sets), 40), row, term, tf)
    df = np.bincount(term, minlength=len(known))
    weight = np.array([math.floor(1000 * math.log((2 * len(sets) + 2) / (2 * d + 1))) for d in df])
    terms = [np.array(sorted(known[w] for w in subject[s][:10])) for s in range(100)]
    search = ranked_search.Search(ranked_search.item_tree(terms, weight), terms, weight, 5, np.zeros(100, np.int64))
    search.run(ranked_search.DocumentTree(docs, len(sets), 40 * len(sets)))
    assert search.scored < 0.1 * len(sets) * len(terms)
    part = 10**9 * tf // (1000 * tf + 8 * 100)
    dense = np.zeros((len(sets), len(known)), np.int64)
    dense[row, term] = part
    for i, t in enumerate(terms):
        scores = dense[:, t] @ weight[t]
        best = np.lexsort((np.arange(len(sets)), -scores))[:5]
        assert search.best.id[i].tolist() == best.tolist() and search.best.score[i].tolist() == scores[best].tolist()
