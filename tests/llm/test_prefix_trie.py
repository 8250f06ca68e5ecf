"""The prefix trie against a trie of dictionaries."""

import hashlib
import random
import zlib

import pytest

from pricewright.llm import prefix_trie, queries
from tests.llm.helpers import empty

SCHEMA = "conv_id long, turn long, role string, text string, conv string, place string, level int, next string"


def brute(convs):
    """Rows of all nodes of {conv: [(role, text)]}, by the plain definition."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    rows = {}
    for prefix in members:
        under = [p for p in members if p[:len(prefix)] == prefix]
        kids = [p for p in under if len(p) == len(prefix) + 1]
        ends = sorted(c for c in members[prefix] if len(convs[c]) == len(prefix))
        rows[min(members[prefix]), len(prefix)] = (
            min(members[prefix[:-1]]) if prefix else None, len(members[prefix]), len(kids),
            sum(not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in under) for p in under),
            sum((len(members[p]) - 1) * len(p[-1][1]) for p in under if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
    return rows


def table(spark, convs):
    return spark.createDataFrame([(c, k, role, text, "c", "p", 1, "n") for c, turns in convs.items()
                                  for k, (role, text) in enumerate(turns)], SCHEMA)


def result(found):
    nodes, ends = found
    digests = queries.member_digests(ends)
    rows = nodes.join(digests, "end", "left").collect()
    none = hashlib.sha256(b"").hexdigest()
    got = {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved"],
                                        r["ends_sha256"] or none) for r in rows}
    assert len(got) == len(rows)
    return got


def conversations(rng, n, kinds, longest):
    made = []
    for _ in range(n):
        turns = [(rng.choice(("user", "assistant")), "t" * rng.randrange(kinds)) for _ in range(rng.randrange(1, longest))]
        if made and rng.random() < 0.6:
            other = rng.choice(made)
            cut = rng.randrange(len(other) + 1)
            turns = other[:cut] + (turns if rng.random() < 0.6 else [])
        made.append(turns or [("user", "")])
    ids = rng.sample(range(-n, 3 * n), n)
    return dict(zip(ids, made))


@pytest.mark.parametrize("seed,chunk,parts", [(0, 64, 4), (1, 3, 4), (2, 1, 3), (3, 2, 13), (4, 4, 1)])
def test_agrees_with_a_trie_of_dictionaries(spark, monkeypatch, seed, chunk, parts):
    monkeypatch.setattr(prefix_trie, "_ranges", lambda rows, spark: parts)
    rng = random.Random(seed)
    convs = conversations(rng, 70, 3, 9)
    assert result(prefix_trie.prefix_trie(table(spark, convs), chunk=chunk)) == brute(convs)


def test_copies_and_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_ranges", lambda rows, spark: 5)
    rng = random.Random(9)
    long = [("user", "x" * rng.randrange(5)) for _ in range(60)]
    convs = {c: long for c in range(20, 50)} | {c: long[:c] for c in range(1, 20)} | {
        60: long + [("user", "more")], 61: long[:30] + [("user", "other")] * 40, 62: [("assistant", "alone")] * 50}
    for chunk in (64, 7):
        assert result(prefix_trie.prefix_trie(table(spark, convs), chunk=chunk)) == brute(convs)


def test_awkward_turns(spark):
    rows = [(1, 1, "user", "b"), (1, None, "user", "first"), (1, 1, "user", "a"), (1, 1, "user", "a"),
            (2, None, None, None), (2, 3, "", ""), (None, 1, "user", "x"), (3, 0, "user:", "a"), (4, 0, "user", ":a"),
            (5, 0, "日本", "🎉" * 3000)]
    turns = spark.createDataFrame([(*r, "c", "p", 1, "n") for r in rows], SCHEMA)
    convs = {1: [("user", "first"), ("user", "a"), ("user", "a"), ("user", "b")], 2: [("", ""), ("", "")],
             3: [("user:", "a")], 4: [("user", ":a")], 5: [("日本", "🎉" * 3000)]}
    assert result(prefix_trie.prefix_trie(turns)) == brute(convs)
    nodes, ends = prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA))
    assert nodes.count() == 0 and ends.count() == 0
    assert empty(spark).count() == 0


def test_conversation_spread_over_ranges_is_numbered_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_ranges", lambda rows, spark: 6)
    turns = [(7, k, "user", str(k)) for k in range(500)] + [(8, 0, "user", "x")]
    random.Random(1).shuffle(turns)
    got = prefix_trie.lettered(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    placed = {(r["conv"], r["place"]): r["letter"] for r in got.collect()}
    letters = {t: r["letter"] for t, r in ((t, prefix_trie.lettered(spark.createDataFrame(
        [(1, 0, "user", t)], "conv_id long, turn long, role string, text string")).first()) for t in ("0", "499"))}
    assert sorted(placed) == [(7, k + 1) for k in range(500)] + [(8, 1)]
    assert placed[7, 1] == letters["0"] and placed[7, 500] == letters["499"]


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(5)
    convs = {}
    for c in [*range(95, 130), *range(200, 215), 301, 302, 1000, -3]:
        convs[c] = [(rng.choice(("user", "assistant")), "t" * rng.randrange(4)) for _ in range(rng.randrange(1, 8))]
    convs[110] = convs[111] = convs[100]
    table(spark, convs).select("conv_id", "turn", "role", "text").write.parquet(f"{tmp_path}/conversations.parquet")
    built = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = convs.get(base, [])[:h] + turns[h:]
    assert any(not t for t in built.values())
    rows = queries.op11_prefix_trie(spark, str(tmp_path)).collect()
    got = {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"],
                                        r["saved_tokens"], r["ends_sha256"]) for r in rows}
    assert len(got) == len(rows) and got == brute(built)
