"""Cohort, bin, distribution and association tables on hand-worked rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from outcomelab.operators import assoc, bins, cohort, dist, profile


def frame(spark, values, labels=None, schema="x double, y int"):
    labels = labels or [i % 2 for i in range(len(values))]
    return spark.createDataFrame(list(zip(values, labels)), schema)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_equal_width_bins_are_closed_on_the_right(spark):
    df = frame(spark, [0.0, 1.0, 1.5, 10.0, None], [1, 0, 1, 1, 1])
    out = bins.equal_width_rate(df, "x", "y", 10)
    assert rows(out.select("bin", "n", "rate"), "bin") == [(1, 2, 0.5), (2, 1, 1.0), (10, 1, 1.0)]


def test_equal_width_matches_comparing_with_every_edge(spark):
    values = [i / 7 for i in range(200)] + [0.1 * i for i in range(100)]
    out = bins.equal_width_rate(frame(spark, values), "x", "y", 13).select("bin", "n")
    edges = np.linspace(min(values), max(values), 14)
    expected = np.maximum(np.searchsorted(edges, values, side="left"), 1)
    assert dict(rows(out)) == {int(b): int((expected == b).sum()) for b in set(expected)}


def test_constant_column_falls_in_one_bin(spark):
    assert rows(bins.equal_width_rate(frame(spark, [2.0] * 4), "x", "y").select("bin", "n")) == \
        [(5, 4)]
    assert rows(bins.quantile_rate(frame(spark, [2.0] * 4), "x", "y").select("bin", "n")) == \
        [(1, 4)]
    hist = dist.histogram(frame(spark, [2.0] * 4, [0] * 4), "x", "y", 4)
    assert rows(hist.select("bin", "lo", "hi", "n")) == [(3, 2.0, 2.25, 4)]


def test_explicit_edges(spark):
    df = frame(spark, [0.0, 50.0, 50.1, 500.0, 501.0], [1, 1, 0, 1, 1])
    out = bins.edge_rate(df, "x", "y", [0, 50, 100, 200, 500])
    assert rows(out, "bin") == [(1, 0.0, 50.0, 1, 1.0), (2, 50.0, 100.0, 1, 0.0),
                                (4, 200.0, 500.0, 1, 1.0)]


def test_repeated_quantile_edges_are_dropped(spark):
    df = frame(spark, [1.0, 1.0, 1.0, 2.0, 3.0])
    assert bins.quantile_edges(df, ["x"], 5)["x"] == pytest.approx([1, 1.4, 2.2, 3])
    assert rows(bins.quantile_rate(df, "x", "y", 5).select("bin", "n"), "bin") == \
        [(1, 3), (2, 1), (3, 1)]


def test_histogram_matches_numpy(spark):
    values = [math.sin(i) * 10 for i in range(300)] + [0.1 * i for i in range(50)]
    out = dist.histogram(frame(spark, values, [1] * 350), "x", "y", 30)
    counts, edges = np.histogram(values, bins=30)
    got = {b: n for _, b, _, _, n, _ in rows(out)}
    assert got == {i + 1: int(n) for i, n in enumerate(counts) if n}
    area = out.agg(F.sum(F.col("density") * (F.col("hi") - F.col("lo"))).alias("a")).first()["a"]
    assert area == pytest.approx(1)


def test_density_close_to_the_exact_kernel_sum(spark):
    values = [math.cos(i) * 5 + i % 3 for i in range(400)]
    out = dist.density(frame(spark, values, [0] * 400), "x", "y", grid=50, bins=1024)
    h = np.std(values, ddof=1) * len(values) ** -0.2
    for _, _, x, d in rows(out):
        exact = np.mean(np.exp(-((x - np.array(values)) / h) ** 2 / 2)) / (h * math.sqrt(2 * math.pi))
        assert d == pytest.approx(exact, abs=2e-4)


def test_box_summary_and_outliers(spark):
    df = frame(spark, [1.0, 2.0, 3.0, 4.0, 100.0, None], [0] * 6)
    r = dist.box_summary(df, "x", "y").first()
    assert (r["q1"], r["median"], r["q3"]) == (2, 3, 4)
    assert (r["whisker_low"], r["whisker_high"], r["outliers"], r["n"]) == (1, 4, 1, 5)
    assert r["notch_high"] == pytest.approx(3 + 1.57 * 2 / math.sqrt(5))


def test_top_categories_order(spark):
    df = frame(spark, ["b", "a", "c", "a", "b", None, None, None], schema="k string, y int")
    assert dist.top_categories(df, "k", 2) == ["a", "b"]


def test_rank_sum(spark):
    a, b = [1.0, 2.0, 2.0, 5.0], [2.0, 3.0, 7.0, 8.0, 9.0]
    df = frame(spark, a + b, [0] * 4 + [1] * 5)
    r = dist.rank_sum_test(df, "x", "y").first()
    u = sum((x > z) + 0.5 * (x == z) for x in a for z in b)
    assert (r["n_0"], r["n_1"], r["u"]) == (4, 5, u)
    assert 0 < r["p_value"] < 1 and r["significant"] is False
    same = dist.rank_sum_test(frame(spark, [1.0] * 6), "x", "y").first()
    assert same["p_value"] == 1.0


def test_group_rate_orders_and_filters(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), ("c", 0), (None, 1), ("d", 1)],
                               "k string, y int")
    assert [r[0] for r in rows(cohort.group_rate(df, "k", "y"))] == ["b", "d", "a", "c"]
    assert rows(cohort.group_rate(df, "k", "y", "positives", 2, positives_only=True)) == \
        [("a", 1, 2, 0.5), ("b", 1, 1, 1.0)]


def test_flags_lift_and_crosstab(spark):
    df = spark.createDataFrame([(1, 0, 1), (0, 1, 0), (0, 0, 0), (1, 1, 1), (0, 0, 1)],
                               "a int, b int, y int")
    got = {g: (n, r) for g, n, r in rows(cohort.flag_rates(df, ["a", "b"], "y"))}
    assert got == {"a": (2, 1.0), "b": (2, 0.5), "neither": (2, 0.5)}
    assert cohort.rate_lift(df, "a", "y").first()["lift"] == pytest.approx(3)
    assert cohort.rate_lift(df.where("a = 1"), "a", "y").first()["lift"] == pytest.approx(1000)
    assert rows(cohort.crosstab(df, "a", "y"), "a") == [
        (0, 2, 1, 3, pytest.approx(100 / 3)), (1, 0, 2, 2, 100.0)]


def test_profile_ignores_nothing_but_nulls(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "a"), (2.0, None)], "x double, k string")
    assert rows(profile.column_profile(df), "column") == [
        ("k", "string", "categorical", 2, 1, pytest.approx(100 / 3), 1),
        ("x", "double", "numeric", 2, 1, pytest.approx(100 / 3), 2)]
    approx = profile.column_profile(df, distinct="approx")
    assert rows(approx.select("column", "distinct"), "column") == [("k", 1), ("x", 2)]
    assert "distinct" not in profile.column_profile(df, distinct="skip").columns


def test_describe_per_class(spark):
    df = frame(spark, [1.0, 2.0, 3.0, 4.0, float("nan")], [0, 0, 1, 1, 1])
    got = {r["y"]: r for r in profile.describe(df, ["x"], "y").collect()}
    assert got[0]["std"] == pytest.approx(np.std([1, 2], ddof=1))
    assert (got[1]["n"], got[1]["q25"], got[1]["max"]) == (2, 3.25, 4.0)


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0), (1.0, 2.0, 1), (1.0, 3.0, 1)],
                               "c double, x double, y int")
    got = {f: r for f, r, _ in rows(assoc.target_correlations(df, "y"))}
    assert got["c"] is None and got["x"] == pytest.approx(np.corrcoef([1, 2, 3], [0, 1, 1])[0, 1])


def test_anova_and_mutual_information_rank_the_useful_column_first(spark):
    data = [(float(i % 2) * 5 + i % 7, float(i * 37 % 11), i % 2) for i in range(400)]
    df = spark.createDataFrame(data, "good double, noise double, y int")
    assert rows(assoc.anova_f(df, ["noise", "good"], "y"))[0][0] == "good"
    mi = dict(rows(assoc.mutual_information(df, ["noise", "good"], "y", 5)))
    assert mi["good"] > mi["noise"] >= 0


def test_wide_correlation_matches_pairwise_numpy(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(1e6, 3.0, (400, 6))
    data[:, 1] = data[:, 0] * 2 + rng.normal(0, 1, 400)
    data[:, 5] = 7.0                                   # constant
    data[rng.random((400, 6)) < .2] = np.nan
    data[300:, 2], data[:300, 3] = np.nan, np.nan      # never present together
    names = [f"c{i}" for i in range(6)]
    df = spark.createDataFrame([tuple(float(v) for v in row) for row in data],
                               ", ".join(f"{c} double" for c in names))
    got = {(a, b): r for a, b, r in rows(assoc.correlation_pairs(df, names))}
    assert len(got) == 15
    for (a, b), r in got.items():
        x, y = data[:, names.index(a)], data[:, names.index(b)]
        ok = ~np.isnan(x) & ~np.isnan(y)
        if ok.sum() < 2 or np.ptp(x[ok]) == 0 or np.ptp(y[ok]) == 0:
            assert r is None, (a, b)
        else:
            assert r == pytest.approx(np.corrcoef(x[ok], y[ok])[0, 1], abs=1e-9), (a, b)


def test_empty_and_one_row_tables(spark):
    one = frame(spark, [1.0])
    for df in (one.limit(0), one):
        wide = df.select(*[F.col("x").alias(f"x{i}") for i in range(6)])
        pairs = rows(assoc.correlation_pairs(wide, wide.columns))
        assert len(pairs) == 15 and {r for _, _, r in pairs} == {None}
        assert rows(dist.density(df, "x", "y")) == []
        assert dist.rank_sum_test(df, "x", "y").first()["p_value"] is None
    assert rows(bins.quantile_rate(one.limit(0), "x", "y")) == []
