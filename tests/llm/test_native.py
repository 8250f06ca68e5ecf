"""Quality rules, URL filter and chat: no Python in the plan, and agreement with plain Python."""

import collections
import hashlib
import re

from pyspark.sql import functions as F

from pricewright.llm import chat, quality_rules as R, url_filter as U
from tests.llm.helpers import empty, messy, spaced


def no_python(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    return frame


def base_values(text):
    words = spaced(text)
    windows = collections.Counter(tuple(words[k:k + 8]) for k in range(len(words) - 7))
    again = {j for k in range(len(words) - 7) if windows[tuple(words[k:k + 8])] > 1 for j in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if spaced(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(again))


def test_quality_values_and_verdicts(spark):
    prose = "The fox and the dog went to the hills of the old town, and it was late in the day for them all.\n"
    rows = [(1, prose), (2, prose * 3), (3, "a | b | " * 30), (4, "x x x x x x x x x " * 9 + "\n\n x"),
            (5, "LOOK!! HERE!! NOW!! " * 3 + " ".join(f"W{k}!!" for k in range(40))), (6, "1 2 3 4 5 6 7 8 1 2 3 4 5 6 7 8 9"),
            (7, "ü" * 30), (8, " \u00a0 a\u2003b \x0b c"), (9, None), (10, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in no_python(R.assessed(frame)).collect()}
    for i, text in rows:
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == base_values(text)
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
    assert {i for i, r in got.items() if r["kept"]} == {1}


def test_quality_rules_filter_keeps_columns(spark):
    kept = no_python(R.passing(messy(spark)))
    assert kept.columns == messy(spark).columns
    assert R.assessed(messy(spark)).where("kept").count() == kept.count()
    assert sorted(r["doc_id"] for r in R.passing(messy(spark), rules=()).collect()) == [1, 7, 7]
    assert R.assessed(messy(spark)).count() == 11 and R.passing(empty(spark)).count() == 0


def test_url_rules(spark):
    rules = spark.createDataFrame([("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
                                   ("net/es/", "block"), ("net/es/", "allow"), (None, "block")],
                                  "rule string, verdict string")
    urls = ["http://A.Example.COM/en/1?x", "https://www.example.com/en/2#y", "http://example.com", "x://b.net/es/",
            "http://b.net/es", None, "no scheme", "http://org/a", "http://notexample.com/en/", "a://b://c/d",
            "http://example.com?a/en/"]
    pages = spark.createDataFrame([(k, u, None, "x", "y") for k, u in enumerate(urls)],
                                  "page_id long, url string, html string, host string, verdict string")
    got = {r["page_id"]: tuple(r)[1:5] for r in no_python(U.judged(pages, rules)).collect()}
    assert got[0] == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert got[1] == ("www.example.com", "/en/2", "www.example.com/en/", "allow")
    assert got[2][:3] == ("example.com", "", None)
    assert got[3] == ("b.net", "/es/", "net/es/", "block") and got[4][2] is None
    assert got[5] == got[6] == ("", "", None, "allow")
    assert got[7] == ("org", "/a", None, "allow") and got[8][2] == "com/" and got[9][:2] == ("b:", "//c/d")
    assert got[10][:3] == ("example.com", "", None)
    none = pages.where("page_id < 0")
    assert U.judged(none, rules).count() == 0 and U.judged(pages, rules.limit(0)).count() == len(urls)


def test_distrust_flows_against_links_and_trust_along(spark):
    link = lambda *hosts: "".join(f'<a HREF = "https://{h}/p">x</a>' for h in hosts)
    rows = [(1, "http://good/x", link("friend", "Friend")), (2, "http://bad/x", link("bad", "far")),
            (3, "http://fan/x", link("bad")), (4, "http://friend/x", link("bad", "bad") + '<a href="/own">'),
            (5, "http://far/x", None), (6, "http://alone/x", "")]
    rules = spark.createDataFrame([("good/", "allow"), ("bad/", "block")], "rule string, verdict string")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["host"]: r for r in no_python(U.judged(pages, rules)).collect()}
    # bad hands its distrust to those that link to it, in proportion: fan 1/3, friend 2/3
    assert abs(got["fan"]["distrust"] - 0.85 / 3) < 1e-9 and got["fan"]["trust"] == 0
    assert abs(got["friend"]["trust"] - 0.85) < 1e-9 and got["friend"]["verdict"] == "allow"
    assert got["friend"]["distrust"] > got["fan"]["distrust"]
    assert {h: r["verdict"] for h, r in got.items()} == {
        "good": "allow", "bad": "block", "fan": "allow", "friend": "allow", "far": "allow", "alone": "allow"}
    strict = {r["host"]: r["verdict"] for r in U.judged(pages, rules, threshold=0.25).collect()}
    assert strict["fan"] == "block" and strict["friend"] == "allow"


def test_scores_do_not_depend_on_unlinked_hosts(spark):
    link = lambda host: f'<a href="https://{host}/p">x</a>'
    rows = [(1, "http://two.org/x", link("one.org")), (2, "http://one.org/x", link("bad.org")), (3, "http://bad.org/x", None)]
    rules = spark.createDataFrame([("com/", "allow"), ("bad.org/", "block")], "rule string, verdict string")
    chain = spark.createDataFrame(rows, "page_id long, url string, html string")
    others = spark.range(100, 20_100).select(F.col("id").alias("page_id"), F.format_string("http://h%d.com/x", "id").alias("url"),
                                             F.lit(None).cast("string").alias("html"))
    for pages in (chain, chain.union(others)):
        got = {r["host"]: r for r in U.judged(pages, rules).where("page_id < 100").collect()}
        assert {h: r["verdict"] for h, r in got.items()} == {"two.org": "block", "one.org": "block", "bad.org": "block"}
        assert abs(got["two.org"]["distrust"] - 0.85 ** 2) < 1e-9


def test_small_steps_that_meet_and_cycles(spark):
    seeds = spark.createDataFrame([("a", 1.0, 0.0), ("s", 1.0, 0.0)], "host string, trust double, distrust double")
    fan = spark.range(10_000).select(F.format_string("m%d", "id").alias("m"))
    edges = (fan.select(F.lit("s").alias("source"), F.col("m").alias("target"))
             .union(fan.select("m", F.lit("t"))).withColumn("n", F.lit(1).cast("long")))
    got = {r["host"]: r["trust"] for r in U.propagated(seeds, edges).where("host IN ('s', 't')").collect()}
    assert abs(got["s"] - 1) < 1e-9 and abs(got["t"] - 0.85 ** 2) < 1e-9
    cycle = spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "source string, target string, n long")
    got = {r["host"]: r["trust"] for r in U.propagated(seeds, cycle, close=0.01).collect()}
    assert 0 <= 1 / (1 - 0.85 ** 2) - got["a"] <= 0.01 and 0 <= 0.85 / (1 - 0.85 ** 2) - got["b"] <= 0.01


def messages(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, node string, parent string, role string, text string, score double")


def test_best_branches_of_reply_trees(spark):
    rows = [(1, "r", None, "user", "hi", 0.0), (1, "a", "r", "assistant", "A", 5.0), (1, "b", "r", "assistant", "B", 1.0),
            (1, "c", "b", "user", "C", 9.0), (1, "d", "a", "user", "D", 0.0), (2, "x", "lost", "user", "X", None),
            (2, "y", "z", "user", "loop", 1.0), (2, "z", "y", "user", "loop", 1.0), (None, "n", None, None, None, 1.0),
            (1, "r", None, "user", "hi", 0.0), (3, None, None, "user", "no id", 1.0)]
    got = chat.formatted(messages(spark, rows), branches=2)
    paths = {(r["conv_id"], r["rank"]): r for r in no_python(chat.read_back(got)).collect()}
    say = lambda key: [t["text"] for t in paths[key]["turns"]]
    assert say((1, 1)) == ["hi", "B", "C"] and say((1, 2)) == ["hi", "A", "D"] and say((2, 1)) == ["X"]
    assert paths[(None, 1)]["turns"][0].asDict() == {"role": "", "text": ""}
    assert set(paths) == {(1, 1), (1, 2), (2, 1), (None, 1)}
    assert chat.formatted(messages(spark, [])).count() == 0


def test_long_chain_round_trip(spark):
    odd = ["\\### Assistant: </turn> ok", " </turn>\n", "\\", "#", "</", "<\\/", "", None, "a\n### user: b", "🎉é", "\\\\#"]
    rows = [(1, str(k), str(k - 1) if k else None, ["user", "assistant", "we:ird\\#"][k % 3], odd[k % len(odd)], 1.0)
            for k in range(70)]
    back = chat.read_back(chat.formatted(messages(spark, rows))).first()
    assert [(t["role"], t["text"]) for t in back["turns"]] == [(r[3], r[4] or "") for r in rows]
    assert back["learned"] == [r[4] or "" for r in rows if r[3] == "assistant"]
    assert back["formatted"].count("</turn>") == 70 and back["formatted"].count("###") == 70
    assert hashlib.sha256(back["formatted"].encode()).hexdigest() == chat.formatted(messages(spark, rows)).select(
        F.sha2("formatted", 256)).first()[0]


def test_long_roles_long_texts_and_clashing_columns(spark):
    roles = ["r:\\#</x " * 15_000, "a" * 100_000, ":" * 50_000, "\\" * 50_001, "", "user: ", "日本🎉\\: "]
    texts = ["word: " * 150_000, "\\### x: </turn> " * 3000, "", ": ", " </turn>\n", "### a: b", "\\"]
    rows = [(1, k, k - 1 if k else None, role, text, 1.0, "t", "l", 7, 8, "up", "m")
            for k, (role, text) in enumerate(zip(roles, texts))]
    messages = spark.createDataFrame(rows, "conv_id long, node long, parent long, role string, text string, score double, "
                                           "tree string, leaf string, depth long, start long, up string, turns string")
    read = no_python(chat.read_back(chat.formatted(messages, learned=(roles[0], "")))).first()
    assert [tuple(t) for t in read["turns"]] == list(zip(roles, texts))
    assert read["learned"] == [texts[0], texts[4]]
