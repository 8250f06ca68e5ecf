"""Periodic runs against all periods at all places."""

import hashlib
import random
import zlib

import pyarrow as pa
import pytest

from pricewright.llm import periodic_runs, queries, words as W
from tests.llm.helpers import empty, messy, spaced


def brute(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        x = 0
        while x < n - q:
            start = x
            while x < n - q and words[x] == words[x + q]:
                x += 1
            if x > start and x + q - start >= max(6, 4 * q):
                found.setdefault((start, x + q), q)
            x += x == start
    return sorted(((start, end - start, q) for (start, end), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {x for start, length, q in runs for x in range(start + q, start + length)}
    return " ".join(w for x, w in enumerate(words) if x not in gone)


def repetitive(rng):
    n, kinds = rng.choice((0, 1, 3, 7, 20, 100, 400, 1500)), rng.choice((1, 2, 3, 5, 50))
    words = [f"w{rng.randrange(kinds)}" for _ in range(n)]
    for _ in range(rng.randrange(4) if n else 0):
        at = rng.randrange(n)
        q = rng.randrange(1, max(2, (n - at) // rng.randrange(2, 9) + 1))
        for i in range(at, min(n, at + int(q * rng.uniform(2, 9)))):
            words[i] = words[at + (i - at) % q]
    if n > 50 and rng.random() < 0.4:  # runs inside the period of a run
        at, q = rng.randrange(n // 2), rng.randrange(8, max(9, n // 8))
        unit = (["z"] * rng.randrange(q) + [f"u{rng.randrange(3)}" for _ in range(q)])[:q]
        for i in range(at, min(n, at + rng.randrange(3 * q, 6 * q))):
            words[i] = unit[(i - at) % q]
    return words


@pytest.mark.parametrize("seed", range(8))
def test_agrees_with_all_periods(seed):
    rng = random.Random(seed)
    texts = [repetitive(rng) for _ in range(60)]
    joined = [rng.choice((" ", "\n", " \t ")).join(t) for t in texts]
    found = W.words(pa.array([t.encode() for t in joined], pa.binary()), W.SPACED)
    rows = periodic_runs.text_runs(found)
    cut = periodic_runs._collapsed(found, rows).to_pylist()
    for d, words in enumerate(texts):
        runs = brute(words)
        assert [(start, end - start, q) for e, start, end, q in rows.tolist() if e == d] == runs
        assert cut[d] == collapsed(words, runs)


def test_strings_rich_in_runs_and_free_of_them():
    fibonacci, other = "a", "ab"
    while len(other) < 3000:
        fibonacci, other = other, other + fibonacci
    thue_morse = [format(k, "b").count("1") % 2 for k in range(4096)]
    periodic = ["a", "b", "a", "a", "b"] * 700
    texts = [list(other), [str(x) for x in thue_morse], periodic, ["x"] * 5, ["x"] * 6, ["x"] * 3000]
    found = W.words(pa.array([" ".join(t).encode() for t in texts], pa.binary()), W.SPACED)
    rows = periodic_runs.text_runs(found).tolist()
    for d, words in enumerate(texts):
        assert [(start, end - start, q) for e, start, end, q in rows if e == d] == brute(words)


def test_words_whose_hashes_agree_are_told_apart(monkeypatch):
    real = W.words

    def colliding(column, by):
        found = real(column, by)
        return found._replace(hashes=found.hashes % 3)
    monkeypatch.setattr(W, "words", colliding)
    texts = [[f"w{k % 5}" for k in range(40)], [f"w{k}" for k in range(60)]]
    found = W.words(pa.array([" ".join(t).encode() for t in texts], pa.binary()), W.SPACED)
    assert periodic_runs.text_runs(found).tolist() == [[0, 0, 40, 5]]


def test_awkward_rows(spark):
    got = sorted((r["doc_id"], r["n_words"], r["runs"], r["collapsed"]) if r["doc_id"] is not None else (0,)
                 for r in periodic_runs.periodic(messy(spark)).collect())
    assert len(got) == messy(spark).count()
    by_id = {g[0]: g for g in got}
    assert by_id[2][1:] == (0, [], "") == by_id[3][1:] == by_id[4][1:]
    assert by_id[5][1] == 120_000
    assert periodic_runs.periodic(empty(spark)).count() == 0


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i, " ".join(repetitive(rng))) for i in range(150)] + [(900, None), (901, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    planted = 0
    for i, text in rows:
        words, h = spaced(text), zlib.crc32(str(i).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words, planted = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)], planted + 1
        runs = brute(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        assert tuple(got[i])[1:] == (
            len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(collapsed(words, runs)))
    assert planted > 5
