"""One-bit codes and the search against brute force."""

import numpy as np
import pytest

from pricewright.llm import one_bit_search as search
from tests.llm.helpers import empty

SCHEMA = "vec_id long, embedding array<float>, score string, list string, vec string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "s", "l", "v")
                                  for i, v in rows], SCHEMA)


def brute(rows, asked, k):
    kept = {i: np.array(v, dtype=np.float32).astype(np.float64) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q in asked:
        if q in kept:
            near = sorted((float(np.sqrt(((kept[q] - v)**2).sum())), i) for i, v in kept.items() if i != q)
            out[q] = near[:k]
    return out


def answers(found):
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["score"], r["vec_id"]))
    return out


def ask(spark, rows, every, **more):
    table = frame(spark, rows)
    return answers(search.nearest(search.build(table, **more), table.where(f"vec_id % {every} = 0")))


def recall(got, wanted):
    return np.mean([len({i for _, i in got[q]} & {i for _, i in wanted[q]}) / len(wanted[q]) for q in wanted])


def test_estimates_stay_within_their_bounds():
    rng = np.random.default_rng(0)
    rows, asked = (x / np.linalg.norm(x, axis=1)[:, None] for x in (
        rng.standard_normal((3000, 50)), rng.standard_normal((100, 50))))
    rotation = search._rotation(50)
    assert np.allclose(rotation @ rotation.T, np.eye(50))
    turned = rows @ rotation
    codes = np.packbits(turned > 0, axis=1, bitorder="little").view(np.uint64)
    cosine = np.abs(turned).sum(axis=1) / 8
    off = (search._estimates(codes, cosine, asked @ rotation) - asked @ rows.T) / (
        np.sqrt(1 - cosine**2) / cosine / np.sqrt(63))
    assert abs(off.mean()) < 0.01 and 0.9 < off.std() < 1.05 and (np.abs(off) > 3).mean() < 0.005


def test_planes_of_a_query_give_its_product_with_the_signs():
    rng = np.random.default_rng(1)
    signs, asked = rng.choice([-1, 1], (40, 128)), rng.uniform(-1, 1, (9, 128))
    codes = np.packbits(signs > 0, axis=1, bitorder="little").view(np.uint64)
    got = search._estimates(codes, np.ones(40), asked) * np.sqrt(128)
    assert np.abs(got - asked @ signs.T).max() < 128 * 2 / 255


@pytest.mark.parametrize("shape", ["sphere", "clusters", "ball"])
def test_recall_against_brute_force(spark, monkeypatch, shape):
    monkeypatch.setattr(search, "CELL", 64)
    monkeypatch.setattr(search, "ASKED", 8)
    rng = np.random.default_rng(2)
    points = rng.standard_normal((1500, 24))
    if shape == "clusters":
        points = 0.1 * points + rng.standard_normal((12, 24))[rng.integers(0, 12, 1500)]
    if shape == "ball":
        points[::2] = points[1] + 1e-3 * points[::2]
    rows = [(i, p.astype(np.float32).tolist()) for i, p in enumerate(points)]
    got, wanted = ask(spark, rows, 20), brute(rows, range(0, 1500, 20), 10)
    assert got.keys() == wanted.keys() and recall(got, wanted) > 0.98
    for q in wanted:
        true = dict((i, d) for d, i in brute(rows, [q], 1500)[q])
        assert got[q] == sorted(got[q]) and all(d == pytest.approx(true[i], abs=1e-12) for d, i in got[q])


def test_copies_ties_and_awkward_vectors(spark):
    rng = np.random.default_rng(3)
    one, other = rng.standard_normal(8).tolist(), rng.standard_normal(8).tolist()
    rows = [(i, one) for i in range(40)] + [(i, other) for i in range(40, 46)] + [(45, other)]
    rows += [(100, None), (101, [0.0] * 8), (102, [float("nan")] + [1.0] * 7), (103, [float("inf")] + [1.0] * 7),
             (104, [None] + [1.0] * 7), (105, [1.0] * 5), (106, []), (None, one)]
    rows = [(i, None if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = ask(spark, rows, 5)
    wanted = brute([r for r in rows if r[0] not in (105,)], [i for i in range(0, 46, 5)], 10)
    assert {q: [i for _, i in a] for q, a in got.items()} == {q: [i for _, i in a] for q, a in wanted.items()}
    assert [i for _, i in got[0]] == list(range(1, 11)) and [i for _, i in got[35]] == list(range(10))


def test_fewer_candidates_than_wanted_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])]
    assert {q: [i for _, i in a] for q, a in ask(spark, rows, 1).items()} == {0: [2, 1], 1: [2, 0], 2: [0, 1]}
    assert ask(spark, rows[:1], 1) == {}
    assert ask(spark, [], 1) == {} and ask(spark, [(1, None)], 1) == {}
    assert empty(spark).count() == 0


def test_result_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((300, 16)).astype(np.float32))]
    table = frame(spark, rows)
    runs = [answers(search.nearest(search.build(t), t.where("vec_id % 10 = 0")))
            for t in (table.repartition(2), table.repartition(7, "vec_id"))]
    assert runs[0] == runs[1]


def test_only_the_plan_of_the_cells_is_sent(spark):
    rng = np.random.default_rng(5)
    table = frame(spark, enumerate(rng.standard_normal((400, 64))))
    index = search.build(table)
    own = table.where("vec_id % 4 = 0").selectExpr("vec_id AS asked", "embedding AS vec")
    lists = spark.createDataFrame([(at,) for at in index.sizes], "list int")
    # one vector for many lists is small in a file and large in memory
    visits = search.staged(own.crossJoin(lists).selectExpr("list", "asked", "vec", "double('inf') AS bound"), "visits")
    plan = search._scan(index, visits, 11, 3.0)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BuildRight") == 2 and "BuildLeft" not in plan
