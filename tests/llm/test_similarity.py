import hashlib
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayflow.llm import fingerprints, jaccard_join, shingles, topk
from tests.compare import compare
from tests.llm import cases

SPACE = " \t\n\x0b\x0c\r"


def shingle_words(text):
    words = "".join(" " if c in SPACE else c for c in text or "").split(" ")
    words = [w for w in words if w]
    k = min(5, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def joined_by_force(rows):
    """(doc_id, class_id, n_links, copies) of every row, from all pairs."""
    sets = [shingle_words(r[1]) for r in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
            links[a] += 1
            links[b] += 1
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        copies = sum(s == sets[i] for s in sets) if sets[i] else 1
        out.append((r[0], min(ids, default=None), links[i], copies, find(i)))
    return out


def edited(words, n, seed):
    rng = np.random.default_rng(seed)
    words = list(words)
    for i in rng.choice(len(words), n, replace=False):
        words[i] = f"w{rng.integers(10**6)}"
    return words


def near_rows():
    """A large group of near copies, chains, and unrelated texts."""
    base = cases.words(120, 50)
    rows = [(i, " ".join(edited(base, i % 4, i)), "en", "a", 1) for i in range(300)]
    rows += [(1000 + i, cases.text(80, 900 + i // 2), "en", "b", 1) for i in range(120)]
    words = cases.words(100, 77)
    for i in range(12):
        rows.append((2000 + i, " ".join(words), "en", "c", 1))
        words = edited(words, 1, i)
    return rows


@pytest.mark.parametrize("rows", [cases.documents(), near_rows(), []], ids=["awkward", "near", "none"])
@pytest.mark.parametrize("block", [256, 16])
def test_join_equals_all_pairs(spark, monkeypatch, rows, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", block)
    got = jaccard_join.jaccard_join(cases.frame(spark, rows)).select("doc_id", "class_id", "n_links", "copies")
    assert cases.plain(got.collect()) == cases.plain([r[:4] for r in joined_by_force(rows)])


def test_one_of_each_keeps_the_least_id(spark):
    rows = near_rows() + cases.documents()
    docs = cases.frame(spark, rows)
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    worded = [r for r in rows if shingle_words(r[1])]
    classes = {}
    for r, (*_, root) in zip(worded, joined_by_force(worded)):
        classes.setdefault(root, []).append(r[0])
    want = [min((i for i in ids if i is not None), default=None) for ids in classes.values()]
    want += [r[0] for r in rows if not shingle_words(r[1])]
    assert cases.plain([(r["doc_id"],) for r in kept.collect()]) == cases.plain([(i,) for i in want])


def test_prefixes_are_shortened_only_when_links_are_missing(spark, monkeypatch):
    seen = []
    real = jaccard_join.compare_blocks
    monkeypatch.setattr(jaccard_join, "compare_blocks", lambda *a: seen.append(a[2]) or real(*a))
    copies = [(i, cases.text(2000, i // 2) + f" {i % 2}", "en", "a", 1) for i in range(40)]
    jaccard_join.jaccard_join(cases.frame(spark, copies)).count()
    assert seen == [8]
    seen.clear()
    jaccard_join.jaccard_join(cases.frame(spark, near_rows())).count()
    assert seen == [8, 5]


def test_a_large_group_hides_no_links_near_the_threshold(spark):
    base = cases.words(600, 50)
    rows = [(i, " ".join(edited(base, 1, i)), "en", "a", 1) for i in range(300)]
    at = len(rows)
    for seed in range(300):
        words = cases.words(188, 5000 + seed)
        changed = list(words)
        for i in (20, 60, 100, 140):  # 164 of 184 shingles stay: 164 / 204 = 0.804
            changed[i] = f"w{seed}"
        rows += [(at + 2 * seed, " ".join(words), "en", "b", 1), (at + 2 * seed + 1, " ".join(changed), "en", "b", 1)]
    got = {r["doc_id"]: r["n_links"] for r in jaccard_join.jaccard_join(cases.frame(spark, rows)).collect()}
    assert sum(got[i] for i in range(at, len(rows))) == 600


def test_components_of_a_path_and_a_star(spark):
    edges = [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(60)] + [("hub", f"s{i:03d}") for i in range(200)]
    labels = jaccard_join.components(spark.createDataFrame(edges, "a string, b string"))
    got = {r["node"]: r["label"] for r in labels.collect()}
    assert len(got) == 61 + 201
    assert {got[f"p{i:03d}"] for i in range(61)} == {"p000"} and {got[f"s{i:03d}"] for i in range(200)} == {"hub"}


def test_found_share_at_the_last_depth():
    assert jaccard_join.found_share(0.8, 20, 5) > 0.9995


def test_word_hashes_depend_on_the_word_alone():
    h = shingles.word_hashes("one two\tone\n\ntwo  é" + "x" * 9000 + " one")
    assert h[0] == h[2] == h[5] and h[1] == h[3] and len(set(h.tolist())) == 3
    assert len(shingles.word_hashes(" \n")) == 0
    a, b = shingles.shingle_set("a b c d e f", 5), shingles.shingle_set("b a c d e f", 5)
    assert len(a) == len(b) == 2 and not set(a.tolist()) & set(b.tolist())


def test_overlaps_of_both_ways():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, 80).astype(np.uint64)) for _ in range(30)]
    pairs = np.array(list(itertools.combinations(range(30), 2)))
    want = [len(np.intersect1d(sets[a], sets[b])) for a, b in pairs]
    assert jaccard_join.overlaps(sets, pairs).tolist() == want
    assert jaccard_join.overlaps(sets, pairs[:5]).tolist() == want[:5]


def phrases(text):
    known, phrase = set(), ""
    for c in text:
        phrase += c
        if phrase not in known:
            known.add(phrase)
            phrase = ""
    return known


def test_fingerprints_of_edits_and_neighbours(spark):
    rows = cases.documents()
    got = fingerprints.compare_with_edits(cases.frame(spark, rows)).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want, likeness = [], []
    for r, following in zip(order, order[1:] + order[:1]):
        text, other = r[1] or "", following[1] or ""
        n = len(text)
        changed = text[: n - n // 2] + other[: n // 2]
        want.append(
            (r[0], n, hashlib.sha256(changed.encode()).hexdigest(),
             fingerprints.written(fingerprints.signature_of(text)), fingerprints.written(fingerprints.signature_of(changed)))
        )
        for end in (changed, other):
            a, b = phrases(text), phrases(end)
            likeness.append(len(a & b) / len(a | b) if a | b else 1.0)
    assert cases.plain([r[:5] for r in got]) == cases.plain(want)
    near = {tuple(r[:5]): (r["near_edited"], r["near_next"]) for r in got}
    estimates = [x for w in want for x in near[w]]
    # Rows that repeat an id and a text have neighbours of their own: compare where there is one.
    single = [i for i, w in enumerate(want) if want.count(w) == 1]
    for i in single:
        assert estimates[2 * i] == pytest.approx(likeness[2 * i], abs=0.2)
        assert estimates[2 * i + 1] == pytest.approx(likeness[2 * i + 1], abs=0.2)
    assert fingerprints.compare_with_edits(cases.frame(spark, [])).count() == 0
    alone = fingerprints.compare_with_edits(cases.frame(spark, rows[:1])).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0


def test_fingerprint_column_and_likeness(spark):
    docs = cases.frame(spark)
    got = {r["text"]: r["f"] for r in docs.select("text", fingerprints.fingerprint(F.col("text")).alias("f")).collect()}
    assert got[None] == got[""] == ""
    same, other = fingerprints.read(got[cases.text(60, 1)]), fingerprints.read(got["Word"])
    assert fingerprints.likeness(same, same) == 1.0 and fingerprints.likeness(same, same[:0]) == 0.0
    assert fingerprints.likeness(same, other) < 0.2


EMBEDDINGS = "vec_id BIGINT, embedding FLOAT[], label INTEGER"


def vectors(n, seed, dims=8):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(size=dims).round(1)], None) for i in range(n)]


@pytest.mark.parametrize("kind", ["ties", "few", "awkward", "none"])
def test_top_k_equals_sql(spark, kind):
    from stayflow.llm.queries import TOP_K_SQL

    nan, inf = float("nan"), float("inf")
    rows = {
        "ties": vectors(700, 1, 3) + [(1000 + i, [1.0, 0.5, -0.5], 1) for i in range(300)],
        "few": vectors(3, 2),
        "awkward": [*vectors(60, 3), (100, None, 1), (150, [], 1), (200, [nan] * 8, 1), (250, [inf] * 8, 1),
                    (300, [None] * 8, 1), (350, [1.0] * 8, 1), (351, [2.0] * 9, 1), (None, [1.0] * 8, 1), (400, [0.0] * 8, 1)],
        "none": [],
    }[kind]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("ids", F.lit(1)).withColumn("group", F.lit(2))
    con = cases.duck(rows, "embeddings", EMBEDDINGS)
    assert compare(con, topk.top_k(df, F.col("vec_id") % 50 == 0), TOP_K_SQL) == []


def test_blocks_are_pruned():
    rng = np.random.default_rng(4)
    values = rng.integers(-5, 6, (topk.BLOCK * 8, 16))
    values[: topk.BLOCK] *= 50
    best = topk.Best(4, 5)
    queries = values[[3, 9, 20, 40]]
    scored = topk.search_blocks(best, np.array([3, 9, 20, 40]), queries, np.arange(len(values)), values)
    assert scored == 4 * topk.BLOCK
    scores = queries @ values.T
    scores[np.arange(4), [3, 9, 20, 40]] = np.iinfo(np.int64).min
    assert (best.score == np.sort(scores, axis=1)[:, :-6:-1]).all()
