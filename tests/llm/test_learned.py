"""Language identification and quality classifier: exact inference and held-out accuracy."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from pricewright.llm import language_id as L, mil_quality as M, queries
from tests.llm.helpers import empty, messy

SF = "/root/testdata/sf0.01"


def test_forward_backward_is_that_of_one_chain():
    rng = np.random.default_rng(0)
    scores, which = rng.normal(size=(30, 3)) * 2, rng.integers(0, 30, 500)
    bounds, moves = np.array([0, 0, 1, 300, 305, 500]), rng.normal(size=(3, 3))

    def plain(words):
        e, m, state, ahead = np.exp(scores[words]), np.exp(moves), np.ones(3) / 3, []
        for t in range(len(words)):
            state = (state @ m) * e[t]
            state /= state.sum()
            ahead.append(state)
        back, out = np.ones(3), np.zeros(3)
        for t in range(len(words) - 1, -1, -1):
            both = ahead[t] * back
            out += both / both.sum()
            back = m @ (e[t] * back)
            back /= back.sum()
        return out
    for chunk in (1, 7, 256):
        got = L.label_mass(scores, which, bounds, moves, chunk)
        want = [plain(which[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
        assert np.abs(got - want).max() < 1e-9


def test_code_switched_text_is_split():
    en, de = "the fox and the dog went to the town ", "der Hund und die Katze sind nicht in dem Haus "
    model = L.trained([en * 3, de * 3] * 20, ["en", "de"] * 20)
    mass = lambda t: L.label_mass(*L._emissions(model, L.W.words(pa.array([t.encode()]), L.W.LETTERS)),
                                  np.array([0, len(t.split())]), model.transitions)[0]
    both = mass(en + de)
    assert both[1] == pytest.approx(9, abs=1.0) and both[0] == pytest.approx(10, abs=1.0)
    assert model.transitions[0, 0] > model.transitions[0, 1]


def test_language_of_held_out_documents(spark):
    docs = queries.table(spark, SF, "documents")
    got = L.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    test = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert np.mean([r["lang"] == r["lang_pred"] for r in test]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_of_awkward_rows(spark):
    got = {r["doc_id"]: r for r in L.identified(messy(spark)).collect()}
    assert [got[k]["lang_pred"] for k in (2, 3, 4, 8, None)] == ["und"] * 5
    assert got[2]["score"] == 0 and got[5]["lang_pred"] in ("de", "en", "fr")
    assert L.identified(empty(spark)).count() == 0
    nothing = L.identified(messy(spark).withColumn("lang", L.F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    kept = L.in_known_language(messy(spark), least=0.0)
    assert kept.columns == messy(spark).columns and 2 not in [r["doc_id"] for r in kept.collect()]


def test_quality_of_held_out_documents(spark):
    docs, labels = queries.table(spark, SF, "documents"), queries.table(spark, SF, "labels")
    got = M.assessed(docs, labels).join(labels.select("doc_id", "quality"), "doc_id", "left").collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    test = [r for r in got if r["held_out"] and r["quality"] is not None]
    good, bad = ([r["score"] for r in test if r["quality"] == q] for q in (1, 0))
    assert np.mean(np.array(good)[:, None] > np.array(bad)) > 0.95
    assert np.mean([r["predicted"] == r["quality"] for r in test]) > 0.9


def test_attention_gradient_and_passages():
    texts = ["the cat sat " * 80, "", "one", "#$ %% | " * 40]
    x, starts = M.passages(pa.array([t.encode() for t in texts]))
    assert np.diff(starts).tolist() == [4, 1, 1, 2] and not x[4].any()
    assert x[:, :M.N_CLASSES].sum(axis=1).round(9).tolist() == [1, 1, 1, 1, 0, 1, 1, 1]
    model = M.trained(texts * 5, [1, 0, 1, 0] * 5, rounds=80)
    weight = M._forward(model, x, starts)[3]
    assert np.add.reduceat(weight, starts[:-1]).round(9).tolist() == [1, 1, 1, 1]
    assert (M.scores(model, x, starts) > 0.5).tolist() == [True, False, True, False]


def test_quality_of_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1), (5, 0), (6, 1), (7, 1), (8, 0), (8, 1), (None, 0), (77, 1), (9, None), (2, 5)],
                                   "doc_id long, quality int")
    got = M.assessed(messy(spark), labels).collect()
    assert len(got) == 11 and all(0 <= r["score"] <= 1 for r in got)
    assert M.assessed(empty(spark), labels).count() == 0
    assert {r["score"] for r in M.assessed(messy(spark), labels.limit(0)).collect()} != set()
