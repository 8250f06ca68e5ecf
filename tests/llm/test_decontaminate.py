"""Contamination and span removal against plain Python."""

import hashlib
import random
import re

import pytest

from pricewright.llm import decontaminate as D
from tests.llm.helpers import FOLD, empty, messy

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(docs, items, size=10):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(str(i))
    out = {}
    for d, t in docs:
        w, hit, own = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    own |= windows[tuple(w[k:k + n])]
                    hit |= set(range(k, k + n))
        digest = hashlib.sha256(",".join(sorted(own)).encode()).hexdigest()
        out[d] = (len(w), len(hit), len(own), digest, bool(hit))
    return out


def tables(seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("ab c1 é Zz q-r".split()) + rng.choice(["", "", ",", "\n"]) for _ in range(n))
    items = [(k, text(rng.choice([1, 2, 9, 10, 11, 30]))) for k in range(9, 15)] + [(20, ""), (21, None), (22, "..")]
    items = [x for x in items if not (x[1] and len(words(x[1])) == 1)] + [(30, "unique")]
    docs = [(k, text(rng.choice([0, 3, 20, 60]))) for k in range(30)]
    docs += [(100 + k, f"{text(5)} {t} {text(4)}") for k, t in items if t] + [(200, None), (201, "an UNIQUE one")]
    return docs, items


@pytest.mark.parametrize("seed,block_words", [(1, 2_000_000), (2, 5)])
def test_agrees_with_plain_python(spark, seed, block_words):
    docs, items = tables(seed)
    got = D.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string"), block_words=block_words)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
           for r in got.collect()}
    assert got == brute(docs, items)


@pytest.mark.parametrize("block_words", [2_000_000, 5])
def test_removed_spans_leave_nothing(spark, block_words):
    docs, items = tables(3)
    frame = spark.createDataFrame([(i, t, "keep") for i, t in docs], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rest = D.remove_spans(frame, bench, drop_share=2.0, block_words=block_words)
    assert rest.columns == frame.columns and rest.count() == len(docs)
    assert not any(x[4] for x in brute([(r["doc_id"], r["text"]) for r in rest.collect()], items).values())
    clean = {i for i, x in brute(docs, items).items() if not x[4]}
    assert {r["doc_id"]: r["text"] for r in rest.collect() if r["doc_id"] in clean} == {
        i: t for i, t in docs if i in clean}
    mostly = D.remove_spans(frame, bench, drop_share=0.5, block_words=block_words)
    assert mostly.count() < len(docs)


def test_cutting_that_joins_a_new_window():
    item = " ".join(f"w{k}" for k in range(20))
    block = D.Block([(1, item.encode())], 10)
    text = " ".join(f"w{k}" for k in range(8)) + " " + item + " " + " ".join(f"w{k}" for k in range(8, 15)) + " end"
    assert D._without_hits(block, text.encode())[0].split() == [b"end"]


def test_rows_and_texts_do_not_depend_on_blocks(spark):
    tail = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    passage = tail("p", 14)
    spelled = passage.split()
    items = [(1, " ".join(spelled[:10])), (2, " ".join(spelled[4:])), (3, tail("a", 12)), (4, tail("b", 12)),
             (5, tail("c", 12))]
    docs = [(1, f"{tail('x', 30)} {passage} {tail('y', 30)}"), (2, f"{tail('a', 12)} {tail('x', 16)} {tail('b', 12)}"),
            (3, f"{tail('x', 30)} {' '.join(tail('c', 12).split()[:6])} {tail('a', 12)} "
                f"{' '.join(tail('c', 12).split()[6:])} {tail('y', 30)}"), (4, tail("x", 9)), (5, None)]
    want = {1: f"{tail('x', 30)}  {tail('y', 30)}", 3: f"{tail('x', 30)}  {tail('y', 30)}", 4: tail("x", 9), 5: None}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    squeeze = lambda t: t and " ".join(t.split())
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert len(list(D.blocks(bench, block_words=5))) > 4
    rest = [{r["doc_id"]: r["text"] for r in D.remove_spans(frame, bench, block_words=n).collect()}
            for n in (D.BLOCK_WORDS, 20, 5)]
    assert rest[0] == rest[1] == rest[2]
    assert {k: squeeze(t) for k, t in rest[0].items()} == {k: squeeze(t) for k, t in want.items()}
    messy_docs, messy_items = tables(3)
    frame = spark.createDataFrame(messy_docs, "doc_id long, text string")
    bench = spark.createDataFrame(messy_items, "item_id long, text string")
    one, many = ({(r["doc_id"], r["text"]) for r in D.remove_spans(frame, bench, block_words=n).collect()}
                 for n in (D.BLOCK_WORDS, 5))
    assert one == many


def test_awkward_rows_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog and runs on"), (None, "ok"), (2, None)],
                                  "item_id long, text string")
    got = D.contamination(messy(spark), bench).collect()
    assert len(got) == 11
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[7]["items"] == ["1"] and by_id[9]["items"] == [""] and by_id[2]["n_words"] == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r["contaminated"] for r in D.contamination(messy(spark), none).collect())
    assert D.contamination(empty(spark), bench).count() == 0
    assert D.remove_spans(messy(spark), none).count() == 11


def test_a_block_is_flat_and_small():
    rng = random.Random(0)
    items = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(400)).encode()) for k in range(250)]
    block = D.Block(items, 10)
    held = len(block.spelled) + block.at.nbytes + sum(x.nbytes for parts in block.lengths.values() for x in parts)
    assert held < 45 * 100_000 + (1 << 20)
    found = D.W.words(D.W.pa.array([b"so " + items[7][1][:200] + b" it"]), D.W.ALNUM)
    assert {i for _, _, owners in block.hits(found) for i in owners} == {"7"}


def _handed(monkeypatch, module):
    """Bytes of text of every call that takes words."""
    seen, taken = [], module.W.words
    monkeypatch.setattr(module.W, "words", lambda column, by: seen.append(column.nbytes) or taken(column, by))
    return seen


def test_words_are_taken_from_a_slice_of_a_batch(monkeypatch):
    tail = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    block = D.Block([(1, tail("p", 12).encode())], 10)
    texts = [f"{tail('x', 200)} {tail('p', 12) if k % 7 == 0 else ''} {tail('y', 200)}".encode() for k in range(60)]
    texts[3], texts[4], texts[7] = None, b"", tail("p", 12).encode()
    pa, kept = D.W.pa, [*D._STATE]
    whole = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(texts, pa.binary())], ["doc_id", "text"])
    blank = [pa.array([0] * 60, pa.int64()), pa.array([0] * 60, pa.int64()), pa.nulls(60, pa.binary()),
             pa.nulls(60, pa.list_(pa.string()))]
    fresh = pa.RecordBatch.from_arrays([whole.column(1), *blank], ["__bytes", *kept])
    held = type("Held", (), {"value": block})
    cut = lambda: [r for b in D._cutter(D._Held([held]), "text", 0.5)([whole]) for r in b.to_pylist()]
    scan = lambda: [r for b in D._scan(held, kept)([fresh]) for r in b.to_pylist()]
    monkeypatch.setattr(D, "SLICE", 1 << 30, raising=False)
    want = cut(), scan()
    assert len(want[0]) == 59 and sum(r["__hit"] > 0 for r in want[1]) == 9
    seen = _handed(monkeypatch, D)
    monkeypatch.setattr(D, "SLICE", 4000, raising=False)
    assert (cut(), scan()) == want
    assert max(seen) < 5000


def test_words_do_not_depend_on_pieces(monkeypatch):
    texts = D.W.pa.array([b"so it " * 900, None, b"x" * 3000, b"a,b;  c"], D.W.pa.binary())
    want = D.W.words(texts, D.W.ALNUM)
    monkeypatch.setattr(D.W, "PIECE", 64)
    got = D.W.words(texts, D.W.ALNUM)
    assert all((a == b).all() for a, b in zip(got, want))
