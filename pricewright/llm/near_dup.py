"""Near duplicates by b-bit MinHash, with every link confirmed on full shingle sets.

1. One pass over the texts gives each document the number of its distinct
   shingles, a digest of the set, 32 band keys of four minima each, and the low
   four bits of its 128 minima packed as bit planes into eight longs.
2. Equal sets fold into one representative (an aggregate, so a text copied a
   million times is one row per task).
3. Representatives that share a band key are candidates. Each is compared with the
   smallest member of its buckets that the packed signatures call closest: a star,
   not all pairs. Confirmed links are contracted to components.
4. Only buckets that still hold several components can hide a link. Their members
   meet in blocks of bounded size: members of the largest component with the
   others, and the others among themselves. Inside a task bit counts of the packed
   signatures find which could be linked; what leaves it is a spanning forest.
   The families found so meet in blocks again, with their texts, and exact
   overlaps decide; again a forest leaves the task.
5. Buckets with more than ``WIDE`` members are first dealt again by pairs (then
   triples) of band keys, which similar documents share too: at a similarity of
   0.85 two documents share fewer than two of 32 bands with a probability of 2e-9
   and none with 6e-11; at 0.8 with 1e-6 and 5e-8.

The estimate corrects for chance collisions of b bits: with C the share of equal
b-bit values, J = (C - 2^-b) / (1 - 2^-b). Pairs estimated ``SLACK`` (over five
standard deviations) below the wanted similarity are not looked at further.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pricewright.llm import marks, words as W
from pricewright.llm.components import components
from pricewright.llm.ship import shipped
from pricewright.staging import staged

HASHES, BANDS, BITS = 128, 32, 4
SLACK = 0.2
WIDE = 16384
DEPTH = 3
#: Members of a block while signatures are compared, and while texts are.
SIGNED_BLOCK, TEXT_BLOCK = 1024, 512
_RNG = np.random.Generator(np.random.PCG64(4))
_FLIP = _RNG.integers(0, 2**32, HASHES, dtype=np.uint32)
_TIMES = _RNG.integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)
_PLANES = BITS * HASHES // 64


def _minima(shingles: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, 2**32 - 1, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 2048):
        block = short[None, at:at + 2048] ^ _FLIP[:, None]
        block *= _TIMES[:, None]
        np.minimum(low, block.min(axis=1), out=low)
    return low


def _band_keys(minima: np.ndarray) -> np.ndarray:
    """Rows of minima to rows of band keys; the band's number is part of the key."""
    rows = minima.reshape(len(minima), BANDS, -1).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(rows.shape[2]):
        key = W.mixed(key + rows[:, :, k])
    return key


def _packed(minima: np.ndarray) -> np.ndarray:
    """The low bits of the minima as bit planes: word w of plane p holds bit p of 64 minima."""
    planes = [np.packbits((minima >> np.uint32(p)).astype(np.uint8) & 1, axis=1) for p in range(BITS)]
    return np.concatenate(planes, axis=1).view(np.uint64)


#: Bytes of text whose words a task holds at a time.
SLICE = 1 << 22


def _signature_batches(words: int):
    def run(batches):
        for batch in batches:
            for low, high in W.slices(batch.column(1), SLICE):
                ids, texts = (batch.column(k).slice(low, high - low) for k in (0, 1))
                sizes, digests, minima = [], [], []
                for own in W.shingles(W.words(texts, W.SPACED), words):
                    sizes.append(len(own))
                    digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                    minima.append(_minima(own))
                table = np.array(minima, dtype=np.uint32).reshape(-1, HASHES)
                lists = [pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32),
                                                  x.view(np.int64).ravel()) for x in (_band_keys(table), _packed(table))]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), *lists],
                    ["id", "n", "digest", "bands", "planes"])
    return run


def signatures(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id, n, digest, bands, planes``."""
    shipped(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("id", kind), T.StructField("n", T.LongType()),
                           T.StructField("digest", T.BinaryType()), T.StructField("bands", longs),
                           T.StructField("planes", longs)])
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text")
                       ).mapInArrow(_signature_batches(words), schema)


def estimate(a: str, b: str) -> Column:
    """Similarity from two arrays of packed planes, corrected for chance collisions."""
    half = HASHES // 64
    unequal = sum(F.bit_count(
        _any_bit([F.col(a)[p * half + w].bitwiseXOR(F.col(b)[p * half + w]) for p in range(BITS)]))
        for w in range(half))
    chance = 2.0 ** -BITS
    return ((1 - unequal / F.lit(float(HASHES))) - chance) / (1 - chance)


def _any_bit(columns: list[Column]) -> Column:
    out = columns[0]
    for column in columns[1:]:
        out = out.bitwiseOR(column)
    return out


def _confirm_batches(words: int, percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            # the words of one slice at a time, as the texts of a slice's other side are about as long
            for low, high in W.slices(batch.column(2), SLICE):
                texts = (batch.column(k).slice(low, high - low) for k in (2, 3))
                for own, other in zip(*(W.shingles(W.words(t, W.SPACED), words) for t in texts)):
                    both = len(np.intersect1d(own, other, assume_unique=True))
                    keep.append(both > 0 and 100 * both >= percent * (len(own) + len(other) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``u, v`` whose full sets are similar enough; every text moves once, a leader's once per pair."""
    kind = pairs.schema["u"].dataType
    left = texts.select(F.col("id").alias("u"), F.col("text").alias("text_u"))
    right = texts.select(F.col("id").alias("v"), F.col("text").alias("text_v"))
    schema = T.StructType([T.StructField("u", kind), T.StructField("v", kind)])
    return pairs.join(left, "u").join(right, "v").select("u", "v", "text_u", "text_v").mapInArrow(
        _confirm_batches(words, percent), schema)


def _mixed_units(rows: DataFrame) -> DataFrame:
    """``unit, id, component`` rows of the units with several components, with their sizes and largest component."""
    parts = rows.groupBy("unit", "component").agg(F.count("*").alias("n"))
    units = parts.groupBy("unit").agg(
        F.count("*").alias("classes"), F.max_by("component", F.struct("n", "component")).alias("main"),
        F.max("n").alias("held"), F.sum("n").alias("size")).where("classes > 1")
    return rows.join(units, "unit")


def _dealt(mixed: DataFrame, block: int) -> DataFrame:
    """Blocks of mixed units that have to meet, as ``part``; ``bin`` puts small parts together.

    Members outside the largest component meet everyone, members of the largest
    component only those outside it: a lone outsider costs one pass over the unit.
    """
    outer = F.col("component") != F.col("main")
    n_outer, n_main = F.ceil((F.col("size") - F.col("held")) / block), F.ceil(F.col("held") / block)
    place = F.pmod(F.xxhash64("id"), F.when(outer, n_outer).otherwise(n_main)) + F.when(outer, 0).otherwise(n_outer)
    last = F.when(outer, n_outer + n_main).otherwise(n_outer) - 1
    bins = 1 + mixed.count() // block
    return (mixed.select("unit", "id", "component", "size", place.alias("place"), last.alias("last"))
            .select("*", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("other")).where("other != place")
            .select("id", "component", "size", F.xxhash64(
                "unit", F.least("place", "other"), F.greatest("place", "other")).alias("part"))
            .select("id", "component", "part", F.when(F.col("size") <= block, F.pmod("part", F.lit(bins)))
                    .otherwise(F.col("part")).alias("bin")))


def _forest(linked: np.ndarray) -> np.ndarray:
    """The smallest row that each row of a symmetric link matrix reaches."""
    label = np.arange(len(linked))
    while True:
        low = np.minimum(label, np.where(linked, label[None, :], len(label)).min(axis=1))
        low = np.minimum(low, low[low])
        if (low == label).all():
            return label
        label = low


def _could_link(n: np.ndarray, planes: np.ndarray, component: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of different components that set sizes and packed signatures allow to be linked."""
    half, out = HASHES // 64, np.zeros((len(n), len(n)), dtype=bool)
    floor = percent / 100 - SLACK
    most = int(HASHES * (1 - (floor * (1 - 2.0 ** -BITS) + 2.0 ** -BITS)))
    for at in range(0, len(n), 128):
        rows = slice(at, at + 128)
        differ = np.zeros((len(n[rows]), len(n)), dtype=np.int64)
        for w in range(half):
            any_bit = planes[rows, None, w] ^ planes[None, :, w]
            for p in range(1, BITS):
                any_bit |= planes[rows, None, p * half + w] ^ planes[None, :, p * half + w]
            differ += np.bitwise_count(any_bit)
        small, large = np.minimum(n[rows, None], n), np.maximum(n[rows, None], n)
        out[rows] = (differ <= most) & (100 * small >= percent * large) & (component[rows, None] != component)
    return out


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, as products of incidence blocks over the shingles found twice or more."""
    sizes = [len(x) for x in sets]
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    shared = times[column] > 1
    row, column = row[shared], (np.cumsum(times > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    width = 4096
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        low, high = np.searchsorted(column, (first, first + width))
        has = np.zeros((len(sets), width), dtype=np.float32)
        has[row[low:high], column[low:high] - first] = 1
        out += has @ has.T
    return out.astype(np.int64)


def _parts(table: pa.Table):
    """Row numbers of each part of a bin."""
    part = table.column("part").to_numpy()
    order = np.argsort(part, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(part[order])) + 1)


def _edges_within(percent: int, words: int | None):
    """Forests of possible links (``words`` is None), or of links confirmed on the texts."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, n = table.column("id"), table.column("n").to_numpy()
        planes = table.column("planes").combine_chunks()
        planes = planes.flatten().to_numpy().view(np.uint64).reshape(-1, _PLANES)
        _, component = np.unique(np.array(table.column("component").to_pylist(), dtype=object), return_inverse=True)
        u, v = [], []
        for rows in _parts(table):
            linked = _could_link(n[rows], planes[rows], component[rows], percent)
            if words is not None and linked.any():
                used = np.flatnonzero(linked.any(axis=1))
                rows, linked = rows[used], linked[np.ix_(used, used)]
                texts = table.column("text").take(pa.array(rows)).combine_chunks()
                both = _overlaps(list(W.shingles(W.words(texts, W.SPACED), words)))
                linked &= 100 * both >= percent * (n[rows, None] + n[rows] - both)
            root = _forest(linked)
            moved = np.flatnonzero(root != np.arange(len(root)))
            u.append(rows[moved])
            v.append(rows[root[moved]])
        take = lambda x: ids.take(pa.array(np.concatenate(x) if x else [], pa.int64()))
        return pa.table({"u": take(u), "v": take(v)})
    return run


def _grouped_edges(parts: DataFrame, percent: int, words: int | None) -> DataFrame:
    kind = parts.schema["id"].dataType
    return parts.groupBy("bin").applyInArrow(_edges_within(percent, words), T.StructType(
        [T.StructField("u", kind), T.StructField("v", kind)]))


def links(owners: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """``node, component`` of the representatives that are linked with another one."""
    light = owners.select("id", "n", "planes")
    side = lambda end: light.select(*(F.col(c).alias(f"{c}_{end}") for c in ("id", "n", "planes")))
    fits = ((F.least("n_u", "n_v") * 100 >= F.greatest("n_u", "n_v") * percent)
            & (estimate("planes_u", "planes_v") >= percent / 100 - SLACK))

    rows = owners.select("id", F.explode("bands").alias("unit"))
    heads = rows.groupBy("unit").agg(F.min("id").alias("head"), F.count("*").alias("size")).where("size > 1")
    shared = staged(rows.join(heads, "unit").select("unit", "id", "head"), "shared")
    star = shared.where("id != head").select(F.col("id").alias("id_u"), F.col("head").alias("id_v")).distinct()
    closest = (star.join(side("u"), "id_u").join(side("v"), "id_v").where(fits)
               .groupBy(F.col("id_u").alias("u"))
               .agg(F.max_by("id_v", F.struct(estimate("planes_u", "planes_v"), "id_v")).alias("v")))
    first = staged(components(_confirmed(closest, texts, words, percent)), "components")
    member = first.select(F.col("node").alias("id"), "component")
    classed = lambda frame: frame.join(member, "id", "left").withColumn(
        "component", F.coalesce("component", "id"))

    mixed = staged(_mixed_units(classed(shared.select("unit", "id"))), "mixed")
    families = []
    for depth in range(DEPTH):
        wide = mixed.where(F.col("size") > WIDE)
        last = depth == DEPTH - 1 or wide.isEmpty()
        near = _dealt(mixed if last else mixed.where(F.col("size") <= WIDE), SIGNED_BLOCK)
        families.append(_grouped_edges(near.join(light, "id"), percent, None))
        if last:
            break
        finer = (wide.select("unit", "id").join(owners.select("id", "bands"), "id")
                 .select("id", "unit", F.explode("bands").alias("band")).where("band != unit")
                 .select("id", F.xxhash64("unit", "band").alias("unit")))
        mixed = staged(_mixed_units(classed(finer)), "mixed")
    possible = families[0]
    for more in families[1:]:
        possible = possible.union(more)
    family = components(possible)
    if family.isEmpty():
        return first
    kin = staged(_mixed_units(classed(family.select(F.col("component").alias("unit"), F.col("node").alias("id")))),
                 "kin")
    late = _grouped_edges(_dealt(kin, TEXT_BLOCK).join(light, "id").join(texts, "id"), percent, words)
    return components(first.select(F.col("node").alias("u"), F.col("component").alias("v")).union(late))


def near_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Class of every document: ``id_col, n_shingles, component_id, kept``.

    Words are runs without white space, A-Z lower-cased; two documents are linked if
    ``100 * intersection >= percent * union`` of their distinct shingles of ``words``
    words. A class is a connected component, named by its smallest id; the document
    with that id is kept.

    A text of fewer words is one shingle. Null and empty texts have none and are
    linked with nothing. A null id has a null class and is kept. Rows that share an
    id are one document to the links, and each gets its own row. An empty table
    gives no rows. Columns other than the two named ones are not looked at.
    """
    table = staged(signatures(docs, words, id_col, text_col), "signatures")
    real = table.where("n > 0 AND id IS NOT NULL")
    owners = staged(real.groupBy("digest").agg(F.min(F.struct("id", "n", "bands", "planes")).alias("o"),
                                               F.max("id").alias("top"))
                    .select("digest", "o.*", (F.col("top") != F.col("o.id")).alias("copied")), "owners")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    linked = links(owners.drop("digest", "copied"), texts, words, percent)
    copied = owners.where("copied").select("digest", F.col("id").alias("owner"))
    named = (table.select("id", "n", "digest").join(copied, "digest", "left")
             .withColumn("owner", F.coalesce("owner", "id"))
             .join(linked.withColumnRenamed("node", "owner"), "owner", "left")
             .withColumn("component", F.coalesce("component", "owner")))
    return named.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                        F.col("component").alias("component_id"),
                        F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def keep_one(docs: DataFrame, *, words: int = 5, percent: int = 80, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One document of each class, the one with the smallest id, with all their columns.

    Rows that share an id are documents of their own here: where ids repeat, id and text
    tell rows apart, and only rows of the same id and text fold into one. Rows without an
    id stay. No text moves for it: rows learn by their place whether they stay.
    """
    own = F.col(f"`{id_col}`")
    rows = marks.placed(docs)
    if rows.where(own.isNotNull()).groupBy(own.alias("__id")).count().where("count > 1").isEmpty():
        classes = near_duplicates(rows, words=words, percent=percent, id_col=id_col, text_col=text_col)
        others = classes.where("NOT kept").select(own.alias("__id"))
        places = rows.select(own.alias("__id"), *marks.PLACE).join(others, "__id", "left_semi")
        return marks.with_mark(rows, places, "__copy").where("NOT __copy").drop("__copy")
    said = F.coalesce(F.sha2(F.col(f"`{text_col}`").cast("binary"), 256), F.lit(""))
    keyed = rows.withColumn("__row", F.concat(own.cast("string"), F.lit(":"), said))
    classes = near_duplicates(keyed, words=words, percent=percent, id_col="__row", text_col=text_col)
    known = staged(keyed.where(own.isNotNull()).groupBy("__row", own.alias("__id")).agg(
        F.min(F.struct(*marks.PLACE)).alias("place")), "known")
    first = classes.where("__row IS NOT NULL").select("__row", "component_id").distinct().join(known, "__row").groupBy(
        "component_id").agg(F.min(F.struct("__id", "__row", "place")).alias("first"))
    marked = marks.with_mark(rows, first.select("first.place.*"), "__kept")
    return marked.where(F.col("__kept") | own.isNull()).drop("__kept")
