import numpy as np
import pytest
from pyspark.sql import functions as F

from outcomelab.llm import rabitq as r

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=5):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            u = np.array(v, np.float32).astype(np.float64)
            good.setdefault(i, []).append(u / np.linalg.norm(u))
    out = {}
    for q, vs in good.items():
        if q % 50 == 0:
            scores = {i: max(float(vs[0] @ u) for u in us if len(u) == len(vs[0]))
                      for i, us in good.items() if i != q and any(len(u) == len(vs[0]) for u in us)}
            out[q] = sorted(scores.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k]
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(20, 24))
    rows = [(i, (base[i % 20] + rng.normal(size=24) * 0.7).astype(np.float32).tolist()) for i in range(700)]
    rows += [(800 + i, rows[3][1]) for i in range(60)]                     # one very common vector
    rows += [(900, None), (901, []), (902, [0.0] * 24), (903, [float("nan")] + [1.0] * 23), (904, [None] + [1.0] * 23),
             (905, [float("inf")] * 24), (None, rows[0][1]), (950, [1.0, 2.0]), (951, [2.0, 1.0]), (1000, [1.0]),
             (1050, (np.array(rows[5][1]) * 1e-30).tolist()), (1051, (np.array(rows[5][1]) * 1e30).tolist())]
    return rows


@pytest.mark.parametrize("size", [64, 10_000])
def test_finds_the_nearest(spark, rows, size):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "1 AS id", "2 AS dim", "3 AS block")
    got = {}
    for x in r.nearest(frame, F.col("vec_id") % 50 == 0, rows=size, query_rows=7).collect():
        got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    want, every = brute(rows), brute(rows, 10 ** 6)
    assert set(got) == {q for q, found in want.items() if found}
    hit = total = 0
    for q, found in got.items():
        found.sort()
        assert [x[0] for x in found] == list(range(1, len(want[q]) + 1))
        own = dict(every[q])
        assert [x[2] for x in found] == pytest.approx([own[x[1]] for x in found], abs=1e-12)
        assert [(x[1], x[2]) for x in found] == sorted(((x[1], x[2]) for x in found), key=lambda x: (-x[1], x[0]))
        hit += len({x[1] for x in found} & {i for i, _ in want[q]})
        total += len(found)
    assert hit / total >= 0.97


def test_equal_vectors_go_by_id_over_many_blocks(spark):
    rng = np.random.default_rng(9)
    one, other = rng.normal(size=24).tolist(), rng.normal(size=24).tolist()
    rows = [(0, one)] + [(400 + i, other) for i in range(40)] + [(1000 + i, (-rng.random(24)).tolist()) for i in range(30)]
    rng.shuffle(rows)
    rows = [(int(i), v) for i, v in rows]
    want = [i for i, _ in brute(rows)[0]]
    for size in (3, 7, 1000):
        got = sorted(r.nearest(spark.createDataFrame(rows, SCHEMA).repartition(5), F.col("vec_id") == 0, rows=size).collect(),
                     key=lambda x: x["rank"])
        assert [x["vec_id"] for x in got] == want
        same = [x for x in got if 400 <= x["vec_id"] < 440]
        assert len({x["score"] for x in same}) <= 1 and (not same or [x["vec_id"] for x in same] == list(range(400, 400 + len(same))))


@pytest.mark.parametrize("copies", [5, 40])
def test_copies_of_a_near_id_take_one_place(spark, copies):
    rng = np.random.default_rng(3)
    base = rng.normal(size=24)
    near = [(i, (base + rng.normal(size=24) * 0.02 * i).astype(np.float32).tolist()) for i in range(9)]
    rows = near + [near[1]] * copies + [near[2]] * copies + [near[0]] * copies
    rows += [(100 + i, rng.normal(size=24).astype(np.float32).tolist()) for i in range(60)]
    got = r.nearest(spark.createDataFrame(rows, SCHEMA).repartition(1), F.col("vec_id") == 0).collect()
    assert sorted(x["rank"] for x in got) == [1, 2, 3, 4, 5]
    assert [x["vec_id"] for x in sorted(got, key=lambda x: x["rank"])] == [i for i, _ in brute(rows)[0]]


def test_bounds_hold_and_choose_few():
    rng = np.random.default_rng(2)
    units = r.units(rng.normal(size=(4000, 64)))
    centre = units.mean(axis=0)
    codes = r.Codes(units, centre)
    outside, chosen = [], []
    for q in range(20):
        estimate, error = codes.bounds(units[q], centre)
        outside.append((np.abs(estimate - units @ units[q]) > error).mean())
        chosen.append((estimate + error >= np.partition(estimate - error, -5)[-5]).mean())
    assert np.mean(outside) < 0.005 and np.mean(chosen) < 0.3


def test_empty_tables(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    assert r.nearest(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert r.nearest(frame, F.col("vec_id") < 0).count() == 0
