"""What has no bound by size any more: strata, groups, categories, density groups, columns, streams."""

import math
import re
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayflow.operators import dictionary as Dc
from stayflow.operators import drift as D
from stayflow.operators import ordering, splits
from stayflow.operators import preprocess as P
from stayflow.operators import quality as Q
from stayflow.operators import quantiles as Qu
from stayflow.operators import stats as St
from stayflow.operators.sizing import scratch_folder
from stayflow.params import BusinessParams, DriftParams, SplitParams
from stayflow.sources.accounts import line_totals
from stayflow.streaming import jobs as J
from stayflow.streaming.store import KeyedSums


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# ---- splits ----------------------------------------------------------------


def split_by_hand(df, label, shares):
    """split and fold of every key from an order of each stratum's rows."""
    rows = df.select("id", label, splits.hash_order("id", 42).alias("h")).collect()
    out = {}
    for value in {r[label] for r in rows}:
        own = sorted((r["h"], r["id"]) for r in rows if r[label] == value)
        n = len(own)
        for i, (_, key) in enumerate(own):
            name = "train" if i < int(n * shares[0] + 1e-9) else "val" if i < int(n * shares[1] + 1e-9) else "test"
            out[key] = (name, i % 5)
    return out


@pytest.mark.parametrize("small", [False, True])
def test_many_strata_are_split_and_folded_exactly(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(splits, "RANKED_ROWS", 3)
    r = np.random.default_rng(5)
    values = [None if v == 7 else int(v) for v in r.integers(0, 200, 3000)] + [500] * 1500
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, label int").repartition(4)
    want = split_by_hand(df, "label", (0.6, 0.8))
    cuts = splits.stratified_cuts(df, "id", "label", SplitParams())
    assert isinstance(cuts, splits.TableCuts)
    split = {r["id"]: r["split"] for r in cuts.apply(df).collect()}
    fold = {r["id"]: r["fold"] for r in splits.stratified_folds(df, "id", "label").collect()}
    assert split == {k: v[0] for k, v in want.items()}
    assert fold == {k: v[1] for k, v in want.items()}


def test_a_hundred_thousand_strata(spark):
    n = 100_000
    df = spark.range(3 * n).select("id", (F.col("id") % n).alias("label"))
    sizes = splits.stratified_split(df, "id", "label").groupBy("label").agg(
        F.count_if(F.col("split") == "train").alias("train"), F.count("*").alias("n")
    )
    assert sizes.groupBy("train", "n").count().collect() == [(1, 3, n)]
    folds = splits.stratified_folds(df, "id", "label").groupBy("label").agg(F.sort_array(F.collect_list("fold")).alias("f"))
    assert folds.groupBy("f").count().collect() == [([0, 1, 2], n)]


# ---- quantiles of many groups -------------------------------------------------


@pytest.mark.parametrize("step", [None, 200])
def test_quantiles_of_many_groups(spark, monkeypatch, step):
    monkeypatch.setattr(Qu, "MAX_GROUPS", 100)
    if step:
        monkeypatch.setattr(Qu, "BRACKET_ROWS", step)
        monkeypatch.setattr(Qu, "SMALL_ROWS", 2_000)
    r = np.random.default_rng(3)
    hot = np.round(r.normal(size=30_000), 4)
    groups, values = list(r.integers(1, 3000, 60_000)) + [0] * len(hot), list(r.exponential(size=60_000)) + list(hot)
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(groups, values)], "g int, x double").repartition(4)
    got = {(r["g"], r["prob"]): r["value"] for r in Qu.exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 1.0], ["g"]).collect()}
    by_group: dict[int, list[float]] = {}
    for g, v in zip(groups, values):
        by_group.setdefault(int(g), []).append(float(v))
    assert len(got) == 4 * len(by_group)
    for g, own in by_group.items():
        for p in (0.0, 0.25, 0.5, 1.0):
            assert got[g, p] == pytest.approx(np.quantile(own, p), rel=1e-12, abs=1e-12)


# ---- categories ------------------------------------------------------------------


def categories(spark):
    lines = [(i, None if i % 7 == 0 else f"v{i % 5}", "xyz"[i % 3] if i % 11 else None, i / 10) for i in range(200)]
    return spark.createDataFrame(lines, "id long, a string, b string, n double")


@pytest.mark.parametrize("drop_first", [True, False])
def test_dictionary_equals_the_literal_path(spark, drop_first):
    df = categories(spark)
    train, new = df.filter("id < 100"), df.withColumn("a", F.when(F.col("id") == 150, "new").otherwise(F.col("a")))
    pre = P.fit_preprocessor(train, ["n"], ["a", "b"], drop_first=drop_first)
    want = {r["id"]: r["features"] for r in pre.transform(new, ["id"]).collect()}
    found = Dc.fit_dictionary(train, ["a", "b"])
    assert found.modes == pre.mode and found.sizes == {c: len(v) for c, v in pre.categories.items()}
    number = {"n": pre.scaled(pre.filled(new, "n"), "n")}
    out = Dc.one_hot_encode(new, found, ["a", "b"], number, drop_first)
    got = {r["id"]: r["features"].toArray().tolist() for r in out.select("id", "features").collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    names = {r["place"]: r["name"] for r in Dc.encoded_names(found, ["a", "b"], ["n"], drop_first).collect()}
    assert [names[i] for i in range(len(names))] == pre.feature_names()
    places = P.ordinal_encode(new, pre.categories)
    literal = new.select("id", *[e.alias(c) for c, e in places.items()]).collect()
    joined = Dc.ordinal_encode(new, found, ["a", "b"]).select("id", "a_place", "b_place").collect()
    assert sorted(tuple(r) for r in literal) == sorted(tuple(r) for r in joined)


def test_a_hundred_thousand_categories(spark):
    n = 100_000
    df = spark.range(3 * n).select("id", F.when(F.col("id") < n, F.col("id")).otherwise(F.lit(n // 2)).cast("string").alias("c"))
    found = Dc.fit_dictionary(df, ["c"])
    assert found.sizes == {"c": n} and found.modes == {"c": str(n // 2)}
    ordered = sorted(map(str, range(n)))
    places = {r["value"]: r["place"] for r in found.table.filter(F.col("rows") > 1).collect()}
    assert places == {str(n // 2): ordered.index(str(n // 2))}
    some = df.filter(F.col("id").isin(0, 77_777, 2 * n))
    got = {r["id"]: r["features"] for r in Dc.one_hot_encode(some, found, ["c"]).select("id", "features").collect()}
    for i, v in got.items():
        place = ordered.index(str(i if i < n else n // 2))
        assert v.size == n - 1 and v.indices.tolist() == ([place - 1] if place else [])


def test_dictionary_of_nothing(spark):
    empty = Dc.fit_dictionary(categories(spark).filter("id < 0"), ["a"])
    assert empty.sizes == {"a": 0} and empty.modes == {"a": None}
    assert Dc.ordinal_encode(categories(spark), empty, ["a"]).agg(F.max("a_place")).first()[0] == -1


# ---- density, profile, correlations ------------------------------------------------


def density_by_hand(values, points):
    n, low, high = len(values), min(values), max(values)
    width = np.std(values, ddof=1) * n**-0.2
    x = (low - 0.5 * (high - low)) + 2 * (high - low) * np.arange(points) / (points - 1)
    kernel = np.exp(-0.5 * ((np.array(values)[None, :] - x[:, None]) / width) ** 2)
    return x, kernel.sum(axis=1) / (n * width * math.sqrt(2 * math.pi)), 1 / (width * math.sqrt(2 * math.pi))


def test_density_of_many_groups_within_its_error(spark):
    r = np.random.default_rng(4)
    groups = {f"g{i}": list(r.normal(size=int(r.integers(2, 9)))) for i in range(1500)}
    groups["large"] = list(r.gamma(0.5, size=5000)) + [50.0]
    groups["one"], groups["equal"] = [1.0], [2.0, 2.0]
    lines = [(g, float(v)) for g, own in groups.items() for v in own] + [("none", None), (None, 1.0)]
    df = spark.createDataFrame(lines, "g string, x double").repartition(4)
    error = St.kde_error(St.KDE_TERMS)
    assert error < 1e-11
    found: dict[str, list] = {}
    for row in St.kde_curve(df, "x", "g", points=41).collect():
        found.setdefault(row["g"], []).append((row["point"], row["x"], row["density"]))
    assert found.keys() == groups.keys() - {"one", "equal"}
    for g, rows in found.items():
        x, density, peak = density_by_hand(groups[g], 41)
        rows.sort()
        assert [p for p, _, _ in rows] == list(range(41))
        assert [v for _, v, _ in rows] == pytest.approx(list(x))
        assert np.abs(np.array([d for *_, d in rows]) - density).max() <= peak * (error + 1e-12)
    assert St.kde_curve(df.filter("g = 'large'"), "x", "g").count() == 1000
    assert St.kde_curve(df.filter("g = 'one'"), "x", "g").count() == 0


def test_profile_counts_by_type(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "a", None, True, {"k": 1}), (1, -0.0, " ", None, None, {"k": 1}), (2, 0.0, None, None, False, None)],
        "i int, d double, t string, n string, b boolean, m map<string,int>",
    )
    got = {r["column"]: tuple(r)[1:] for r in St.column_profile(df).collect()}
    assert got["i"] == ("int", 0, 0.0, 0, 2) and got["t"] == ("string", 1, 33.33, 1, 2)
    assert got["n"] == ("string", 3, 100.0, 0, 0) and got["b"][-1] == 2 and got["m"][-1] == 1
    assert "Union" not in plan(St.column_profile(df))
    assert St.column_profile(df.filter("i > 5")).collect() == []


def test_profile_keys_are_as_wide_as_the_types(spark):
    names = [f"t.{i}" for i in range(20)]
    lines = [(i % 3, i % 3, float("nan") if i % 2 else None, *[f"{i % (k + 1)}" for k in range(19)], " ") for i in range(40)]
    df = spark.createDataFrame(lines, "i int, l long, d double, " + ", ".join(f"`{n}` string" for n in names)).repartition(3)
    found = St.column_profile(df)
    keys = [len(k.split(",")) - 1 for k in re.findall(r"hashpartitioning\(([^)]*)\)", plan(found))]
    assert max(keys) <= 1 + len({"int", "bigint", "double", "string"})
    want = [("i", "int", 0, 0.0, 0, 3), ("l", "bigint", 0, 0.0, 0, 3), ("d", "double", 20, 50.0, 0, 1)]
    want += [(n, "string", 0, 0.0, 0, k + 1) for k, n in enumerate(names[:19])] + [("t.19", "string", 0, 0.0, 40, 1)]
    assert [tuple(r) for r in found.collect()] == want


def test_line_totals_are_exact(spark):
    prices = [(1, 0.1), (1, 0.2), (1, -0.05), (2, 9_999_999_999.99), (2, 9_999_999_999.99), (3, None), (None, 1.0), (None, 2.0)]
    lines = spark.createDataFrame(prices, "l_orderkey long, l_extendedprice double")
    found = line_totals(lines)
    # Wide decimals are no part of the grouping's state.
    assert "sum(line_total" not in plan(found) and dict(found.dtypes)["line_total"] == "decimal(22,2)"
    got = {r[0]: None if r[1] is None else str(r[1]) for r in found.collect()}
    assert got == {1: "0.25", 2: "19999999999.98", 3: None, None: "3.00"}


def test_correlation_with_the_label_is_one_grouping(spark):
    r = np.random.default_rng(8)
    x = r.normal(size=(300, 40)) + 1e3
    x[:, 5] = 0.1
    y = (x[:, 0] + r.normal(size=300) > 1e3).astype(float)
    held = r.random(x.shape) > 0.1
    labelled = r.random(300) > 0.1
    held[:, 6] = False
    names = [f"k{i}" for i in range(40)]
    lines = [
        (float(t) if ok else None, *[float(v) if h else None for v, h in zip(a, b)])
        for t, ok, a, b in zip(y, labelled, x, held)
    ]
    df = spark.createDataFrame(lines, "y double, " + ", ".join(f"{n} double" for n in names)).repartition(3)
    found = St.target_corr(df, names, F.col("y"))
    few = St.target_corr(df, names[:2], F.col("y"))
    # The aggregation does not grow with the columns.
    assert plan(found).count("covar") == plan(few).count("covar") > 0
    got = {q["column"]: q["corr"] for q in found.collect()}
    assert len(got) == 40 and got["k5"] is None and got["k6"] is None
    for i in set(range(40)) - {5, 6}:
        both = held[:, i] & labelled
        assert got[names[i]] == pytest.approx(np.corrcoef(x[both, i], y[both])[0, 1], abs=1e-9)
    none = St.target_corr(df.filter("y > 5"), names, F.col("y")).collect()
    assert [tuple(q) for q in none] == [(n, None, None) for n in sorted(names)]


def test_correlations_of_two_hundred_columns(spark):
    r = np.random.default_rng(6)
    x = r.normal(size=(400, 200)) @ r.normal(size=(200, 200)) + 1e6
    x[:, 7] = 3.3
    held = r.random(x.shape) > 0.1
    lines = [[float(v) if h else None for v, h in zip(a, b)] for a, b in zip(x, held)]
    names = [f"k{i}" for i in range(200)]
    df = spark.createDataFrame(lines, ", ".join(f"{n} double" for n in names)).repartition(4)
    got = {(q["a"], q["b"]): q["corr"] for q in St.corr_matrix(df, names).collect()}
    assert len(got) == 200 * 200
    for i, j in [(0, 0), (0, 1), (5, 199), (17, 18), (7, 3), (3, 7), (7, 7)]:
        both = held[:, i] & held[:, j]
        want = None if 7 in (i, j) else np.corrcoef(x[both, i], x[both, j])[0, 1]
        assert got[names[i], names[j]] == (want if want is None else pytest.approx(want, abs=1e-9))


# ---- drift -------------------------------------------------------------------------


def test_all_columns_of_whole_tables_in_one_pass(spark, monkeypatch):
    monkeypatch.setattr(ordering, "BUCKET_ROWS", 50)
    r = np.random.default_rng(7)
    a = [(float(x), None if i % 5 == 0 else float(round(y, 1)), "z") for i, (x, y) in enumerate(r.normal(size=(500, 2)))]
    b = [(float(x) + 0.3, float(round(y, 1)), "z") for x, y in r.normal(size=(300, 2))]
    left, right = (spark.createDataFrame(v, "x double, y double, t string").repartition(3) for v in (a, b))
    got = {q["column"]: (q["n_ref"], q["n_new"], q["ks_statistic"]) for q in D.ks_tables(left, right, ["x", "y", "t"]).collect()}
    for i, c in enumerate("xy"):
        own = [[v[i] for v in side if v[i] is not None] for side in (a, b)]
        grid = sorted(set(own[0] + own[1]))
        gap = max(abs(np.mean(np.array(own[0]) <= g) - np.mean(np.array(own[1]) <= g)) for g in grid)
        assert got[c] == (len(own[0]), len(own[1]), pytest.approx(gap))
    assert "t" not in got
    report = {q["column"]: q["status"] for q in D.drift_between(left, right.drop("y"), ["x", "y", "t"]).collect()}
    assert report == {"x": "DRIFT_DETECTED", "y": "MISSING_IN_NEW_DATA", "t": "NO_VALID_VALUES"}


def test_one_law_at_every_size(spark):
    from stayflow.functions.pvalues import ks_limit, ks_p_value

    sizes = spark.createDataFrame([(0.02, n, n) for n in (9_999, 10_000, 10_001)], "d double, n long, m long")
    chances = [q[0] for q in sizes.select(ks_p_value("d", "n", "m")).collect()]
    assert chances == [ks_limit(0.02, n, n) for n in (9_999, 10_000, 10_001)]
    exact = sizes.limit(1).select(ks_p_value("d", F.lit(50), F.lit(40), law="exact")).first()[0]
    assert 0 <= exact <= 1
    assert DriftParams().max_reference_samples is None


# ---- streams ------------------------------------------------------------------------


def test_sums_by_key_are_maintained(spark):
    folder = scratch_folder(spark)
    store = KeyedSums(spark, folder, ("k", "long"), {"v": "decimal(20,2)"}, buckets=4)
    rows = lambda data: spark.createDataFrame(data, "k long, v decimal(20,2)")
    from decimal import Decimal as Dec

    assert store.read().collect() == [] and store.join(rows([(1, None)]).select("k")).first()["v"] is None
    store.merge(rows([(1, Dec(5)), (1, Dec(2)), (2, Dec(1)), (None, Dec(9))]), 0)
    store.merge(rows([(1, Dec(10)), (3, None)]), 1)
    store.merge(rows([(1, Dec(10)), (3, None)]), 1)  # the same batch again counts once
    want = {1: Dec(17), 2: Dec(1), 3: None}
    assert {r["k"]: r["v"] for r in store.read().collect()} == want
    store.compact()
    assert store.tables() == ["folded=1"]
    store.merge(rows([(2, Dec(4))]), 2)
    assert {r["k"]: r["v"] for r in store.read().collect()} == {**want, 2: Dec(5)}
    joined = store.join(spark.createDataFrame([(2,), (8,)], "k long"))
    assert {r["k"]: r["v"] for r in joined.collect()} == {2: Dec(5), 8: None}
    touched = {r[0] for r in spark.range(1).select(F.lit(2).cast("long").alias("k")).select(store.bucket()).collect()}
    assert "PartitionFilters: [isnotnull(bucket" in plan(store.read(list(touched))) or "bucket" in plan(store.read(list(touched)))


def test_second_micro_batch_reads_no_old_line_items(spark, sf_dir, tmp_path):
    from stayflow.params import ACCOUNT_COLUMNS
    from stayflow.operators.scoring import score_batch
    from stayflow.plans.features import MODEL_FIELDS, fitted
    from stayflow.plans.scoring import MODEL
    from stayflow.plans.streams import score_orders
    from stayflow.sources.accounts import accounts

    fit = fitted(spark, sf_dir)
    lines, orders = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders"))
    feeds = {}
    for name, df, key in (("lineitem", lines, "l_orderkey"), ("orders", orders, "o_orderkey")):
        feeds[name] = str(tmp_path / name)
        for part in (0, 1):
            df.filter(F.col(key) % 2 == part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/parts/{name}{part}")
        shutil.copytree(f"{tmp_path}/parts/{name}0", feeds[name])
    folder = scratch_folder(spark)
    run = lambda: score_orders(
        spark, sf_dir, *(J.stream_table(spark, feeds[n], "*.parquet") for n in ("lineitem", "orders")), fit, folder
    )
    half = run().count()
    assert half == orders.filter("o_orderkey % 2 = 0").count()
    # The first line items are gone: only maintained totals can tell what they were.
    shutil.rmtree(feeds["lineitem"])
    for name in feeds:
        shutil.copytree(f"{tmp_path}/parts/{name}1", feeds[name], dirs_exist_ok=True)
    both = run()
    batch = score_batch(accounts(spark, sf_dir, MODEL_FIELDS), fit.preprocessor, MODEL, fit.medians, 0.5, ACCOUNT_COLUMNS)
    columns = ["account_id", "prediction_status", "churn_probability", "decision"]
    assert both.count() == orders.count()
    assert both.select(columns).exceptAll(batch.select(columns)).count() == 0


# ---- small leftovers ------------------------------------------------------------------


def test_column_differences_and_final_check(spark):
    df = spark.createDataFrame([(1, "Yes", None), (2, "No", "x"), (2, "No", "x"), (3, None, " ")], "id long, y string, t string")
    sides = {tuple(r) for r in Q.column_differences(df, ["id", "y", "y", "other"]).collect()}
    assert sides == {("t", "missing"), ("other", "extra")}
    got = {(r["item"], r["name"]): (r["count"], r["share"]) for r in Q.final_check(df, "id", "y").collect()}
    assert got == {
        ("rows", ""): (4, 1.0), ("distinct_keys", "id"): (3, 0.75), ("copies", ""): (1, 0.25),
        ("missing", "y"): (1, 0.25), ("missing", "t"): (2, 0.5),
        ("label", "Yes"): (1, pytest.approx(1 / 3)), ("label", "No"): (2, pytest.approx(2 / 3)),
    }


def test_value_of_a_correct_contact():
    assert BusinessParams().correct_contact_value == 550.0
    assert BusinessParams(clv=100, success_rate=0.5, contact_cost=60).correct_contact_value == -10.0
