"""Ordered target statistics, nearest-neighbour information, exact rank test, thinned ROC, bytes."""

import hashlib
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from outcomelab.operators import dist, evaluate, nearest, split
from outcomelab.operators import target_stats as T
from outcomelab.sources import readers


def rows_with_a_hot_level(n=300):
    rng = random.Random(5)
    return [(None if i % 50 == 7 else i // 2 * 2 if i % 10 == 3 else i,
             rng.choice(["hot", "hot", "a", "b", None, "it's"]),
             rng.choice([0, 1, 1, None])) for i in range(n)]


def test_ordered_statistics_see_only_earlier_rows(spark):
    rows = rows_with_a_hot_level()
    df = spark.createDataFrame(rows, "id long, k string, y int")
    got = sorted(map(str, T.ordered_target_statistics(df, ["k"], "y", "id", prior_weight=2).collect()))
    known = [y for *_, y in rows if y is not None]
    prior = sum(known) / len(known)
    mark = lambda i: hashlib.md5(f"{'' if i is None else i}|42".encode()).hexdigest()
    want = []
    for i, k, y in rows:
        seen = [v for j, l, v in rows if l == k and mark(j) < mark(i) and v is not None]
        want.append((i, k, y, (sum(seen) + 2 * prior) / (len(seen) + 2)))
    got = sorted(map(tuple, T.ordered_target_statistics(df, ["k"], "y", "id", prior_weight=2).collect()), key=str)
    assert len(got) == len(rows)
    key = lambda r: (str(r[:3]), r[3])
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3])


def test_a_hot_level_is_spread_over_the_buckets(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") > 9, "hot").alias("k"), (F.col("id") % 2).alias("y"))
    buckets = df.select(F.substring(split.row_hash("id", 42), 1, T.BUCKET_DIGITS).alias("b")).groupBy("b").count()
    assert buckets.agg(F.max("count")).first()[0] < 40
    plan = T.ordered_target_statistics(df, ["k"], "y", "id")._jdf.queryExecution().executedPlan().toString()
    assert all("__bucket" in line for line in plan.splitlines() if "Window" in line and "specifiedwindow" in line)


def test_work_grows_linearly_with_the_columns(spark):
    df = spark.range(20).select("id", *[(F.col("id") % k).alias(f"k{k}") for k in (2, 3, 4, 5)],
                                (F.col("id") % 2).alias("y"))

    def windows(*columns):
        out = T.ordered_target_statistics(df, columns, "y", "id")
        return out._jdf.queryExecution().optimizedPlan().toString().count("Window [")

    assert windows("k2", "k3", "k4", "k5") <= 4 * windows("k2")


def test_fitted_statistics_of_seen_unseen_and_missing_levels(spark):
    train = spark.createDataFrame(rows_with_a_hot_level(), "id long, k string, y int")
    fitted = T.fit_target_statistics(train, ["k"], "y")
    new = spark.createDataFrame([(1, "hot"), (2, "new"), (3, None)], "id long, k string")
    got = {r["id"]: r["k_stat"] for r in T.apply_target_statistics(new, fitted, ["k"]).collect()}
    rows = [(k, y) for _, k, y in rows_with_a_hot_level() if y is not None]
    prior = sum(y for _, y in rows) / len(rows)
    for i, k in ((1, "hot"), (3, None)):
        own = [y for l, y in rows if l == k]
        assert got[i] == pytest.approx((sum(own) + prior) / (len(own) + 1))
    assert got[2] == pytest.approx(prior)
    empty = T.apply_target_statistics(new, T.fit_target_statistics(train.limit(0), ["k"], "y"), ["k"])
    assert {r["k_stat"] for r in empty.collect()} == {0.0}
    assert T.ordered_target_statistics(train.limit(0), ["k"], "y", "id").count() == 0


def psi(n):
    return -0.5772156649015329 + sum(1 / j for j in range(1, n))


def plain_information(rows, k):
    rows = [(x, y) for x, y in rows if x is not None and x == x and y is not None]
    size = {y: sum(b == y for _, b in rows) for _, y in rows}
    rows = [r for r in rows if size[r[1]] > 1]
    if not rows:
        return None
    total = 0.0
    for i, (x, y) in enumerate(rows):
        own = min(k, size[y] - 1)
        r = sorted(abs(x - a) for j, (a, b) in enumerate(rows) if b == y and j != i)[own - 1]
        m = sum(a == x if r == 0 else x - r < a < x + r for a, _ in rows)
        total += psi(own) - psi(size[y]) - psi(m)
    return max(0.0, psi(len(rows)) + total / len(rows))


@pytest.mark.parametrize("k,buckets", [(3, None), (1, 2), (5, 40)])
def test_neighbour_information_equals_all_pairs(spark, k, buckets):
    rng = random.Random(k)
    rows = []
    for i in range(220):
        y = rng.choice([0, 0, 0, 0, 1, None])
        rows.append((rng.gauss(y or 0, 1), float(rng.randrange(4)), rng.choice([None, float("nan"), 1.0]),
                     float(10 ** rng.randrange(-3, 6)), 2 if i == 5 else y))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, y int")
    got = {r["feature"]: r["mi"] for r in nearest.neighbour_information(df, "abcd", "y", k, buckets=buckets).collect()}
    for j, c in enumerate("abcd"):
        assert got[c] == pytest.approx(plain_information([(r[j], r[4]) for r in rows], k), abs=1e-9)
    nothing = nearest.neighbour_information(df.limit(0), ["a"], "y", k).collect()
    assert [tuple(r) for r in nothing] == [("a", None)]


def test_rows_of_a_class_do_not_meet_in_one_task(spark):
    values = spark.range(100).select((F.col("id") % 2).alias("y"), F.col("id").cast("double").alias("x"),
                                     F.lit(1).cast("long").alias("n"), F.lit(0.0).alias(nearest.BUCKET))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = nearest._radii(values, 3)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_digamma(spark):
    got = spark.range(1, 60).select(nearest.digamma(F.col("id")).alias("v")).collect()
    assert [r["v"] for r in got] == pytest.approx([psi(n) for n in range(1, 60)], abs=1e-11)


@pytest.mark.parametrize("m,n", [(1, 1), (2, 5), (3, 3), (4, 6)])
def test_rank_sum_counts_by_enumeration(m, n):
    counts = [0] * (m * n + 1)
    for chosen in itertools.combinations(range(m + n), m):
        counts[sum(chosen) - m * (m - 1) // 2] += 1
    assert dist.rank_sum_counts(m, n) == counts == dist.rank_sum_counts(n, m)


def test_rank_sum_test_is_exact_when_small_and_untied(spark):
    rows = [(float(v), 1 if v in (2, 5, 6) else 0) for v in range(9)]
    df = spark.createDataFrame(rows, "x double, y int")
    r = dist.rank_sum_test(df, "x", "y").first()
    orders = [sum(c) - 3 for c in itertools.combinations(range(9), 3)]
    far = max(sum((2, 5, 6)) - 3, 18 - (sum((2, 5, 6)) - 3))
    assert r["p_value"] == pytest.approx(min(1, 2 * sum(u >= far for u in orders) / len(orders)))
    tied = dist.rank_sum_test(df.withColumn("x", F.floor(F.col("x") / 2)), "x", "y").first()
    assert tied["p_value"] == pytest.approx(math.erfc(tied["z"] / math.sqrt(2)))


@pytest.mark.parametrize("parts", [2, 50])
def test_thinned_roc_keeps_corners_and_area(spark, parts):
    rng = random.Random(9)
    rows = [(rng.randrange(40) / 40, int(rng.random() < .3)) for _ in range(300)]
    rows += [(1 + k / 100, 1) for k in range(30)] + [(-k / 100, 0) for k in range(1, 30)]
    df = spark.createDataFrame(rows, "s double, y int")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        whole, thin = (sorted((r["fpr"], r["tpr"], -r["threshold"]) for r in
                              evaluate.roc_points(df, "y", "s", thinned).collect()) for thinned in (False, True))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    steps = {}
    for s, y in rows:
        steps.setdefault(s, [0, 0])[y] += 1
    order = sorted(steps, reverse=True)
    kept = {s for i, s in enumerate(order) if i in (0, len(order) - 1) or steps[order[i + 1]] != steps[s]}
    assert {-t for _, _, t in thin if t != -math.inf} == kept
    area = lambda p: sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(p, p[1:]))
    assert area(thin) == pytest.approx(area(whole)) and len(thin) < len(whole) - 40


@pytest.mark.parametrize("raw, expected", [
    ("x,name\n1,real � mark\n".encode(), "UTF-8"), (b"x\n" + b"ok\n" * 5000 + b"bad \xe9 byte\n", "ISO-8859-1"),
    ("x\nJosé\n".encode("utf-8-sig"), "UTF-8"), (b"", "UTF-8"), (b"x\n\xed\xa0\x80\n", "ISO-8859-1"),
    (b"x\n" + "€".encode() * 200_000, "UTF-8"), (b"x\n\xc3", "ISO-8859-1")])
def test_encoding_by_bytes(spark, tmp_path, raw, expected):
    (tmp_path / "f.csv").write_bytes(raw)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7")
    try:
        small = len(raw) < 200
        if not small:
            spark.conf.set("spark.sql.files.maxPartitionBytes", "4001")
        assert readers.detect_encoding(spark, str(tmp_path / "f.csv")) == expected
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    strict = readers.detect_encoding(spark, str(tmp_path / "f.csv"), ["US-ASCII", "windows-1252", "latin1"])
    assert strict in ("US-ASCII", "windows-1252", "latin1")


def test_splits_keep_rows_without_an_id(spark):
    df = spark.range(200).select(F.when(F.col("id") % 40 != 3, F.col("id")).alias("id"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    for out in (split.stratified_split(df, "y", "id", .2, .2), split.stratified_split(df, "y", "id"),
                split.stratified_folds(df, "y", "id", 5)):
        name = out.columns[-1]
        assert out.count() == 200 and out.where(F.col(name).isNull()).count() == 0
        assert out.where("id IS NULL").select(name, "y").distinct().count() == out.where("id IS NULL").select("y").distinct().count()
