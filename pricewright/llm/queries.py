"""The registered queries of this subpackage; the SQL some must agree with is in ``oracles``."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pricewright.llm import (
    chat, decontaminate, html_text, language_id, mil_quality, mixing, near_dup, one_bit_search, periodic_runs,
    prefix_trie, quality_rules, token_counts, url_filter,
)
from pricewright.llm.oracles import ORACLES  # noqa: F401
from pricewright.llm.ship import shipped
from pricewright.staging import staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(table(spark, sf_dir, "documents"))


# The rules the URL query is judged by.
URL_RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return url_filter.judged(table(spark, sf_dir, "pages"), rules)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items")


def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assessed(table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def edits_of(text: str) -> Column:
    """Three edits of a document at places its text decides: an insertion, a deletion, a replacement."""
    at = lambda k: F.pmod(F.xxhash64(text, F.lit(k)), F.length(text) + 1)
    edit = lambda k, size, new: F.struct(
        at(k).alias("start"), (at(k) + size).alias("end"), F.lit(new).alias("replacement"))
    return F.when(F.length(text) > 0, F.array(edit(0, 0, " revised,"), edit(1, 25, ""), edit(2, 10, "New text ")))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.counted(table(spark, sf_dir, "documents"))
    new = token_counts.recounted(counts, edits_of("text"))
    return new.select("doc_id", "n_before", "n_tokens", F.length("text").cast("long").alias("n_chars"), "n_encoded",
                      F.size(F.filter("tree_chars", lambda x, k: (x > 0) & (k >= F.size("tree_chars") / 2)))
                      .cast("long").alias("n_leaves"))


def as_replies(turns: DataFrame) -> DataFrame:
    """Rows by turn as reply trees of one path: each message answers the one before it."""
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    return turns.select("conv_id", "role", "text", place.alias("node")).withColumn(
        "parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.length("text"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)],
                                "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    read = chat.read_back(chat.formatted(as_replies(turns)))
    line = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(line, 256).alias("turns_sha256"), F.length(learned).cast("long").alias("loss_chars"),
                       F.sha2(learned, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op10_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mil_quality.assessed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def rebuilt(letters: DataFrame) -> DataFrame:
    """Conversation c begins with the first h turns of conversation c - c % 100, and goes on with its own after h."""
    conv = F.col("conv")
    base, h = conv - conv % 100, (F.crc32(conv.cast("string").cast("binary")) % 6).alias("h")
    heads = staged(letters.where((conv % 100 == 0) & (F.col("place") <= 5)), "heads")
    lengths = heads.groupBy(conv.alias("base")).agg(F.max("place").alias("n"))
    own = letters.withColumn("h", h).where("place > h").withColumn("base", base).join(lengths, "base", "left").select(
        "conv", (F.col("place") - F.col("h") + F.least("h", F.coalesce("n", F.lit(0)))).alias("place"), "letter", "size")
    convs = letters.select("conv").distinct().select("conv", base.alias("base"), h)
    taken = convs.join(heads.withColumnRenamed("conv", "base"), "base").where("place <= h").select(
        "conv", "place", "letter", "size")
    return own.unionByName(taken)


def _streamed_digests(batches):
    """SHA-256 of the comma-joined parts of each name; rows come sorted by name."""
    name, digest = None, None
    for batch in batches:
        done = []
        for own, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if own != name:
                if name is not None:
                    done.append((name, digest.hexdigest()))
                name, digest = own, hashlib.sha256(part.encode())
            else:
                digest.update(b"," + part.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done), (pa.binary(), pa.string()))],
                                             ["end", "ends_sha256"])
    if name is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([digest.hexdigest()])],
                                         ["end", "ends_sha256"])


def member_digests(ends: DataFrame) -> DataFrame:
    """``end, ends_sha256`` of ascending members; blocks of 1,024 ids are joined first, a name's blocks are streamed."""
    shipped(ends.sparkSession)
    blocks = ends.groupBy("end", F.floor(F.col("conv") / 1024).alias("block")).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("part"))
    return blocks.repartition("end").sortWithinPartitions("end", "block").select("end", "part").mapInArrow(
        _streamed_digests, "end binary, ends_sha256 string")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = staged(prefix_trie.lettered(table(spark, sf_dir, "conversations")), "turns")
    nodes, ends = prefix_trie.trie(staged(rebuilt(letters), "rebuilt"), letters.select("conv").distinct())
    digests = staged(member_digests(ends), "digests")
    named = nodes.join(digests, "end", "left")
    return named.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                        F.col("saved").alias("saved_tokens"),
                        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def op12_one_bit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return one_bit_search.nearest(one_bit_search.build(vectors), vectors.where("vec_id % 100 = 0"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; a tenth of the documents, by their id, repeat some of their words to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", r"[ \t-\r]+"), lambda w: w != "")
    cut = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, words).alias("words")).withColumn(
        "n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int")).withColumn(
        "p", F.expr("cast(1 + floor((n - a) / (3 + g % 8)) as int)"))
    planted = F.expr("""array_join(concat(slice(words, 1, a), slice(flatten(array_repeat(
        slice(words, a + 1, p), cast(ceil((n - a) / p) as int))), 1, n - a)), ' ')""")
    return cut.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic(with_planted_runs(table(spark, sf_dir, "documents")))
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("minus"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(
        r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), (-F.col("best.minus")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("floor(1000 * -best.minus / best.period)").cast("long").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_url_filter": op2_url_filter,
    "op3_decontaminate": op3_decontaminate,
    "op4_near_dup": op4_near_dup,
    "op5_quality_rules": op5_quality_rules,
    "op6_html_text": op6_html_text,
    "op7_mixing": op7_mixing,
    "op8_token_counts": op8_token_counts,
    "op9_chat": op9_chat,
    "op10_mil_quality": op10_mil_quality,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_one_bit_search": op12_one_bit_search,
    "op13_periodic_runs": op13_periodic_runs,
}
