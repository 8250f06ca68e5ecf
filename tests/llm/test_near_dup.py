"""Near duplicates against all pairs."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from pricewright.llm import near_dup, words as W
from pricewright.llm.components import components
from tests.llm.helpers import FOLD, empty, messy, spaced


def brute(rows, words, percent):
    sets = {}
    for i, t in rows:
        w = spaced((t or "").translate(FOLD))
        sets[i] = {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def family(rng, n, edits):
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.choice(edits)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("wide,block", [(16384, 512), (8, 4)])
def test_agrees_with_all_pairs(spark, monkeypatch, wide, block):
    monkeypatch.setattr(near_dup, "WIDE", wide)
    monkeypatch.setattr(near_dup, "SIGNED_BLOCK", block)
    monkeypatch.setattr(near_dup, "TEXT_BLOCK", block)
    rng = random.Random(5)
    texts = [*family(rng, 40, (0, 1, 2, 3, 4, 5, 6)), *family(rng, 30, (2, 3)), *family(rng, 1, (0,)),
             "a b", "a b", "A  b\n", "a", "", " ", None]
    rng.shuffle(texts)
    rows = [(3 * k, t) for k, t in enumerate(texts)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=85)
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == brute(rows, 3, 85)


def test_packed_estimate_is_the_share_of_equal_low_bits(spark):
    minima = np.random.default_rng(0).integers(0, 2**32, (2, near_dup.HASHES), dtype=np.uint32)
    minima[1, :100] = minima[0, :100]
    planes = near_dup._packed(minima).view(np.int64)
    equal = (minima[0] % 16 == minima[1] % 16).mean()
    got = spark.createDataFrame([(planes[0].tolist(), planes[1].tolist())], "a array<long>, b array<long>").select(
        near_dup.estimate("a", "b")).first()[0]
    assert got == pytest.approx((equal - 1 / 16) / (1 - 1 / 16))
    linked = near_dup._could_link(np.array([9, 9]), planes.view(np.uint64), np.array([0, 1]), 80)
    assert linked.tolist() == [[False, got >= 0.6], [got >= 0.6, False]]


def test_awkward_rows_and_empty_table(spark):
    got = near_dup.near_duplicates(messy(spark), words=3, percent=85).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == 11
    assert by_id[2]["n_shingles"] == by_id[3]["n_shingles"] == by_id[4]["n_shingles"] == 0
    assert by_id[7]["component_id"] == 1 and not by_id[7]["kept"] and by_id[1]["kept"]
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    assert by_id[8]["kept"] and by_id[5]["n_shingles"] > 10_000
    assert near_dup.near_duplicates(empty(spark)).count() == 0
    stay = near_dup.keep_one(messy(spark))
    assert stay.columns == messy(spark).columns
    assert sorted(r[0] for r in stay.select("doc_id").collect() if r[0]) == [1, 2, 3, 4, 5, 6, 8, 9]


def test_repeated_rows_fold_when_kept(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "q r s t u v")]
    assert near_dup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).count() == 2


def test_one_id_with_two_texts_when_kept(spark):
    first, second, third = "a b c d e f", "q r s t u v", "k l m n o p"
    rows = [(1, first), (1, second), (10, first), (9, third), (9, third.upper()), (9, second), (None, first), (None, first)]
    got = near_dup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r[0] or 0, r[1].lower()) for r in got) == [(0, first), (0, first), (1, first), (1, second), (9, third)]
    rows = [(0, second), (1, first), (1, second), (2, first)]
    got = near_dup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == [(0, second), (1, first)]


def test_components(spark):
    edges = [(k, k + 1) for k in range(20)] + [(100, 101), (103, 101), (7, 7)] + [(500, k) for k in range(400, 450)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert {k for k, v in got.items() if v == 0} == set(range(21))
    assert got[103] == 100 and got[500] == 400 and len(got) == 21 + 3 + 51
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_words_of_a_batch(monkeypatch):
    monkeypatch.setattr(W, "PIECE", 7)
    texts = ["Ab  cd\n", "", "cd", None, "x" * 40 + " ab", "é É ab"]
    found = W.words(pa.array([None if t is None else t.encode() for t in texts], pa.binary()), W.SPACED)
    spelled = [found.text_of(k, W.SPACED.folded).decode() for k in range(len(found.hashes))]
    assert spelled == [w for t in texts for w in spaced((t or "").translate(FOLD))]
    assert np.diff(found.bounds).tolist() == [2, 0, 1, 0, 2, 3]
    same = {w: {h for x, h in zip(spelled, found.hashes.tolist()) if x == w} for w in set(spelled)}
    assert all(len(v) == 1 for v in same.values()) and len({min(v) for v in same.values()}) == len(same)


def test_pairs_are_confirmed_by_slices(monkeypatch):
    text = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n)).encode()
    u = [text(k, 100) for k in range(40)]
    v = [text(k, 95) if k % 2 else text(k + 1, 100) for k in range(40)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(40)), pa.array(range(100, 140)), pa.array(u, pa.binary()), pa.array(v, pa.binary())],
        ["u", "v", "text_u", "text_v"])
    seen, taken = [], W.words
    monkeypatch.setattr(W, "words", lambda column, by: seen.append(column.nbytes) or taken(column, by))
    monkeypatch.setattr(near_dup, "SLICE", 2000)
    rows = [r for b in near_dup._confirm_batches(3, 85)([batch]) for r in b.to_pylist()]
    assert rows == [{"u": k, "v": k + 100} for k in range(1, 40, 2)]
    assert max(seen) < 3000
