"""Mixing: targets against resharing step by step, totals of the cube method, determinism."""

import random

import numpy as np
import pytest

from pricewright.llm import mixing as M
from tests.llm.helpers import empty, messy


def reshared(sizes, weights=(3, 1, 2), share=1.5, ceiling=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, free, budget = {}, set(names), share * sum(sizes.values())
    while free:
        part = {s: budget * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if part[s] > ceiling * sizes[s]}
        if not over:
            return target | part
        for s in over:
            target[s] = ceiling * sizes[s]
            budget -= target[s]
        free -= over
    return target


def frame(spark, sizes):
    rows = [(k, " ".join(["w"] * n), s) for k, (s, n) in enumerate(sizes)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_targets_and_totals(spark):
    rng = random.Random(3)
    sizes = [(s, rng.randint(1, 400)) for s, n in (("a", 150), ("b", 90), ("Z", 40), ("é", 5), (None, 20)) for _ in range(n)]
    total = {s: sum(n for x, n in sizes if x == s) for s in {s for s, _ in sizes}}
    want = reshared(total)
    got = M.mixture(frame(spark, sizes), block=24).collect()
    again = M.mixture(frame(spark, sizes).repartition(5), block=24).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again)) and len(got) == len(sizes)
    taken = {s: 0 for s in total}
    for r in got:
        source, size = sizes[r["doc_id"]]
        assert r["size"] == size and r["source_size"] == total[source] and r["taken"] in (0, size, 2 * size)
        assert r["target"] == pytest.approx(want[source])
        taken[source] += r["taken"]
    for s in total:
        assert abs(taken[s] - want[s]) < 0.03 * want[s] + 1


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(0)
    size = rng.integers(1, 500, 300).astype(float)
    end = M.flight(np.full(300, 0.37), size, 12, rng)
    assert ((end > 0) & (end < 1)).sum() <= 12
    assert end.sum() == pytest.approx(0.37 * 300, abs=1e-6)
    assert end @ size == pytest.approx(0.37 * size.sum(), rel=1e-6)
    done = M.landing(end, size)
    assert set(done) <= {0.0, 1.0} and abs(done @ size - 0.37 * size.sum()) < 500
    same = M.flight(np.full(50, 0.5), np.full(50, 7.0), 2, rng)
    assert same.sum() == pytest.approx(25)


def test_chances_are_kept_on_average():
    size = np.array([3.0, 8, 2, 9, 4, 4, 7, 1, 5, 6])
    ends = [M.flight(np.full(10, 0.3), size, 2, np.random.default_rng(k)) for k in range(600)]
    assert np.abs(np.mean(ends, axis=0) - 0.3).max() < 0.08


def test_awkward_rows(spark):
    got = M.mixture(messy(spark)).collect()
    assert len(got) == 11
    assert all(r["taken"] == 0 for r in got if r["size"] == 0) and all(r["taken"] <= 2 * r["size"] for r in got)
    kept = M.mixed(messy(spark))
    assert kept.where("doc_id = 7").count() in (0, 2) and kept.where("taken = 0").count() == 0
    assert kept.count() == sum(r["taken"] > 0 for r in got)
    assert M.mixture(empty(spark)).count() == 0 and M.mixed(empty(spark)).count() == 0
    no_words = M.mixture(messy(spark).where("doc_id IN (2, 3)")).collect()
    assert [r["taken"] for r in no_words] == [0, 0]
    with pytest.raises(ValueError):
        M.mixture(messy(spark), block=3)
