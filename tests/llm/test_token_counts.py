"""Edit-aware counts against encoding the whole edited text."""

import random

from hypothesis import given, settings, strategies as st

from pricewright.llm import queries, token_counts as K
from tests.llm.helpers import empty, messy

count = K.counter(open(K.VOCABULARY, "rb").read())
ALPHABET = "ab  \n'sé1 .,\u3000\x1c!\t\u00a0"


@settings(max_examples=150, deadline=None)
@given(st.text(ALPHABET, max_size=80), st.lists(st.tuples(
    st.integers(-3, 90), st.integers(-3, 90), st.text(ALPHABET, max_size=30)), max_size=6), st.sampled_from([1, 3, 8]))
def test_any_edits(text, edits, leaf):
    K.LEAF, whole = leaf, K.LEAF
    try:
        tree = K.Tree.of(text, count)
        for start, end, new in edits:
            tree.edit(start, end, new, count)
            low = min(max(start, 0), len(text))
            text = text[:low] + new + text[min(max(end, low), len(text)):]
            assert tree.text() == text and tree.tokens[1] == count(text) and tree.chars[1] == len(text)
            tree = K.Tree.kept(text, tree.chars, tree.tokens)
    finally:
        K.LEAF = whole


def test_only_touched_leaves_are_encoded():
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdé") for _ in range(6)) for _ in range(20_000))
    tree, seen = K.Tree.of(text, count), []
    n = tree.edit(70_000, 70_003, "zz", lambda t: seen.append(t) or count(t))
    assert n < 4 * K.LEAF and sum(map(len, seen)) == n
    assert tree.tokens[1] == count(tree.text())


def test_query_agrees_with_full_encoding(spark):
    sf = "/root/testdata/sf0.001"
    docs = queries.table(spark, sf, "documents").select("doc_id", "text", queries.edits_of("text").alias("edits"))
    got = {r["doc_id"]: r for r in queries.op8_token_counts(spark, sf).collect()}
    for r in docs.collect():
        text = r["text"] or ""
        before = count(text)
        for e in r["edits"] or []:
            low = min(e["start"], len(text))
            text = text[:low] + e["replacement"] + text[min(max(e["end"], low), len(text)):]
        g = got[r["doc_id"]]
        assert (g["n_before"], g["n_tokens"], g["n_chars"]) == (before, count(text), len(text))


def test_awkward_rows_and_edit_table(spark):
    counts = K.counted(messy(spark))
    got = {r["doc_id"]: r for r in counts.collect()}
    assert got[2]["n_tokens"] == got[3]["n_tokens"] == 0 and got[9]["n_tokens"] == count("日本語 ÀÉ\x00 🎉 ok")
    edits = spark.createDataFrame([(2, 1, 0, 9, "new"), (2, 2, 3, 3, " text"), (9, 1, -5, 2, None), (77, 1, 0, 0, "x")],
                                  "doc_id long, seq int, start long, end long, replacement string")
    new = K.recounted(K.with_edits(counts, edits), K.F.col("edits"))
    got = {r["doc_id"]: r for r in new.collect()}
    assert new.count() == 11 and got[2]["text"] == "new text" and got[2]["n_tokens"] == count("new text")
    assert got[9]["text"] == "語 ÀÉ\x00 🎉 ok" and got[5]["n_encoded"] == 0 and got[5]["n_tokens"] == got[5]["n_before"]
    assert K.counted(empty(spark)).count() == 0
