"""Nearest neighbours by randomly rotated one-bit codes whose error bounds choose what is compared exactly.

``build`` gives every vector a list, the nearest of a few hundred centres fitted on a
bounded sample, and a code: its offset from the centre is rotated by a fixed random
rotation, and the signs of the coordinates are packed, one bit each. With two
numbers beside it, the offset's length r and the cosine x between the offset and its
own sign vector, the code estimates any inner product: a query's offset from
the same centre is rotated alike and cut into eight bit planes, so that its product
with the signs is a sum of bit counts. Divided by x that is an unbiased estimate of
the cosine between both offsets; it is off by more than ``error`` * sqrt(1 - x^2) / x / sqrt(D - 1)
as rarely as a normal value by ``error`` deviations (3: one in 700 to one side).

``nearest`` asks each distinct query vector at its own list first; the distance of the
last neighbour found there bounds the search. Lists whose ball around the centre
lies beyond that bound are left out, which is exact; all others are scanned. In a scan, vectors
whose lower bound exceeds the bound or the k-th smallest upper bound are left out, the
others are compared in double precision.

Lists and their queries meet in cells of bounded size. Of equal vectors only the
k + 1 with the smallest ids can be anyone's neighbours, and equal queries are asked once,
so neither makes a cell heavy.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from pricewright.llm.ship import shipped
from pricewright.staging import staged

#: Centres at most, sample vectors per centre, and bytes of the sample, which the driver holds.
LISTS, PER_LIST, SAMPLE_BYTES = 1024, 64, 1 << 26
#: Vectors and queries of a cell at most, about; bytes of the arrays of one step.
CELL, ASKED, STEP_BYTES = 8192, 2048, 1 << 24
PLANES = 8


class Shared(NamedTuple):
    """What every task needs: centres (C, D) and the rotation (D, D rounded up to 64)."""

    centres: np.ndarray
    rotation: np.ndarray


class Index(NamedTuple):
    """Encoded vectors, and per list the number of rows and the greatest distance from its centre."""

    table: DataFrame
    shared: Broadcast
    sizes: dict[int, int]
    radii: np.ndarray
    dims: int


def _rows(column: pa.Array, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec`` of the rows with an id and a finite vector other than zero."""
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kind = vectors.schema[vec_col].dataType.elementType
    vec = F.col(f"`{vec_col}`")
    return vectors.select(
        F.col(f"`{id_col}`").alias("id"),
        (vec if isinstance(kind, (T.FloatType, T.DoubleType)) else vec.cast("array<double>")).alias("vec")).where(
        "id IS NOT NULL AND vec IS NOT NULL").where(finite & F.exists("vec", lambda x: x != 0))


def _fitted(sample: np.ndarray, lists: int) -> np.ndarray:
    """Centres of a sample by a few rounds of Lloyd's algorithm; an empty list keeps its centre."""
    centres = sample[:lists].copy()
    for _ in range(8):
        own = _closest(sample, centres)
        order = np.argsort(own, kind="stable")
        at, first = np.unique(own[order], return_index=True)
        centres[at] = np.add.reduceat(sample[order], first) / np.diff(np.append(first, len(own)))[:, None]
    return centres


def _closest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half, out = (centres**2).sum(axis=1) / 2, np.empty(len(rows), np.int32)
    step = max(1, STEP_BYTES // (8 * len(centres)))
    for at in range(0, len(rows), step):
        out[at:at + step] = np.argmax(rows[at:at + step] @ centres.T - half, axis=1)
    return out


def _rotation(dims: int) -> np.ndarray:
    """The first ``dims`` rows of a random rotation of a multiple of 64 dimensions."""
    wide = -(-dims // 64) * 64
    turned, scale = np.linalg.qr(np.random.Generator(np.random.PCG64(12)).standard_normal((wide, wide)))
    return (turned * np.sign(np.diag(scale)))[:dims]


def _encoded(shared: Broadcast):
    def run(batches):
        centres, rotation = shared.value
        dims, wide = rotation.shape
        for batch in batches:
            if not len(batch):
                continue
            rows = _rows(batch.column(1), dims).astype(np.float64)
            own = _closest(rows, centres)
            rows = rows - centres[own]
            length = np.sqrt((rows**2).sum(axis=1))
            turned = rows @ rotation
            bits = np.packbits(turned > 0, axis=1, bitorder="little")
            cosine = np.abs(turned).sum(axis=1) / (np.where(length > 0, length, 1) * np.sqrt(wide))
            cosine[length == 0] = 1
            codes = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(wide // 8), len(rows), [None, pa.py_buffer(bits.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(own), *batch.columns, codes, pa.array(length), pa.array(np.minimum(cosine, 1))],
                ["list", "id", "vec", "code", "length", "cosine"])
    return run


def build(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10,
          lists: int = LISTS) -> Index | None:
    """The index of all usable vectors of the most frequent length; None if there is none.

    Centres are fitted on a sample of ``PER_LIST`` vectors a list that the ids decide, ``SAMPLE_BYTES``
    at most; every vector is indexed. It serves searches for up to ``k`` neighbours.
    """
    spark = shipped(vectors.sparkSession)
    rows = usable(vectors, id_col, vec_col)
    common = rows.groupBy(F.size("vec").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if common is None:
        return None
    dims, n = common
    same = Window.partitionBy("vec").orderBy("id")
    base = staged(rows.where(F.size("vec") == dims).withColumn("copy", F.dense_rank().over(same)).where(
        F.col("copy") <= k + 1).dropDuplicates(["vec", "id"]).select("id", "vec"), "vectors")
    wanted = min(LISTS, lists, max(1, int(n**0.5)))
    held = min(PER_LIST * wanted, max(wanted, SAMPLE_BYTES // (8 * dims)))
    sample = base.where(F.pmod(F.xxhash64("id"), F.lit(max(n, held))) < held).select(
        F.xxhash64("id", F.lit(1)).alias("h"), "vec").orderBy("h", "vec").limit(held).toArrow()
    if not len(sample):
        sample = base.select("id", "vec").orderBy("id").limit(1).toArrow()
    points = _rows(sample.column("vec"), dims).astype(np.float64)
    centres = _fitted(points, min(wanted, max(1, len(points) // 8)))
    shared = spark.sparkContext.broadcast(Shared(centres, _rotation(dims)))
    schema = T.StructType([
        T.StructField("list", T.IntegerType()), *base.schema.fields, T.StructField("code", T.BinaryType()),
        T.StructField("length", T.DoubleType()), T.StructField("cosine", T.DoubleType())])
    table = staged(base.mapInArrow(_encoded(shared), schema), "index")
    sizes, radii = {}, np.zeros(len(centres))
    for at, size, radius in table.groupBy("list").agg(F.count("*"), F.max("length")).collect():
        sizes[at], radii[at] = size, radius
    return Index(table, shared, sizes, radii, dims)


def _estimates(codes: np.ndarray, cosine: np.ndarray, turned: np.ndarray) -> np.ndarray:
    """Estimated inner products of unit queries (rows) with the unit vectors behind packed signs (columns)."""
    wide = turned.shape[1]
    low = turned.min(axis=1, keepdims=True)
    step = np.maximum((turned.max(axis=1, keepdims=True) - low) / (2**PLANES - 1), 1e-300)
    whole = np.round((turned - low) / step).astype(np.uint64)
    total = np.zeros((len(turned), len(codes)), dtype=np.int64)
    for p in range(PLANES):
        plane = np.packbits(((whole >> np.uint64(p)) & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little").view(np.uint64)
        for w in range(wide // 64):
            total += np.bitwise_count(plane[:, w, None] & codes[None, :, w]).astype(np.int64) << p
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    signed = 2 * (low * ones + step * total) - (low * wide + step * whole.sum(axis=1, keepdims=True))
    return signed / np.sqrt(wide) / cosine


def _compared(rows: np.ndarray, asked: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Distances of the queries ``at`` and the vectors ``to``, in double precision."""
    out, step = np.empty(len(at)), max(1, STEP_BYTES // (8 * rows.shape[1]))
    for low in range(0, len(at), step):
        part = slice(low, low + step)
        # summed along the first axis: one coordinate after the other, as a plain loop would
        out[part] = np.sqrt((np.ascontiguousarray((rows[to[part]].astype(np.float64) - asked[at[part]]).T)**2).sum(axis=0))
    return out


def _scanned(shared: Broadcast, keep: int, error: float):
    """The ``keep`` nearest vectors of a cell for each of its queries, within the query's bound."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        centres, rotation = shared.value
        dims, wide = rotation.shape
        out: list[list] = [[], [], []]
        if len(left) and len(right):
            rows = _rows(left.column("vec"), dims)
            ids = left.column("id").combine_chunks()
            codes = np.frombuffer(b"".join(left.column("code").to_pylist()), dtype=np.uint64).reshape(len(rows), -1)
            length, cosine = (left.column(c).to_numpy() for c in ("length", "cosine"))
            spread = np.sqrt(1 - cosine**2) / cosine * error / np.sqrt(max(wide - 1, 1))
            asked = _rows(right.column("vec"), dims).astype(np.float64)
            names, bound = right.column("asked").combine_chunks(), right.column("bound").to_numpy()**2
            centre = centres[left.column("list")[0].as_py()]
            order = np.argsort(np.argsort(ids.to_numpy(zero_copy_only=False), kind="stable"), kind="stable")
            step = max(1, STEP_BYTES // (8 * len(rows)))
            for low in range(0, len(asked), step):
                own = asked[low:low + step]
                offset = own - centre
                far = np.sqrt((offset**2).sum(axis=1, keepdims=True))
                turned = offset @ rotation / np.where(far > 0, far, 1)
                product = _estimates(codes, cosine, turned)
                middle, slack = length**2 + far**2, 2 * length * far
                limit = bound[low:low + step].copy()
                if len(rows) > keep:
                    upper = middle - slack * (product - spread)
                    limit = np.minimum(limit, np.partition(upper, keep - 1, axis=1)[:, keep - 1])
                at, to = np.nonzero(middle - slack * (product + spread) <= limit[:, None] * (1 + 1e-9) + 1e-12)
                distance = _compared(rows, own, at, to)
                best = np.lexsort((order[to], distance, at))
                at, to, distance = at[best], to[best], distance[best]
                place = np.arange(len(at)) - np.searchsorted(at, at)
                good = place < keep
                for column, part in zip(out, (names.take(pa.array(at[good] + low)), ids.take(pa.array(to[good])),
                                              pa.array(distance[good]))):
                    column.append(part)
        kinds = (right.schema.field("asked").type, left.schema.field("id").type, pa.float64())
        return pa.table([pa.chunked_array(x, kind) for x, kind in zip(out, kinds)], ["asked", "id", "distance"])
    return run


def _scan(index: Index, visits: DataFrame, keep: int, error: float) -> DataFrame:
    """``asked, id, distance`` for rows ``list, asked, vec, bound``: lists and their queries meet in cells.

    The plan of the cells, a row a list, is what both joins send. The visits repeat a query's vector for each list: a
    few bytes a row in their file and hundreds in memory, so the file's size must not decide.
    """
    spark = visits.sparkSession
    asked = dict(visits.groupBy("list").count().collect())
    plan = F.broadcast(spark.createDataFrame(
        [(at, -(-index.sizes[at] // CELL), -(-asked[at] // ASKED)) for at in asked if at in index.sizes],
        "list int, blocks int, parts int"))
    key = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = index.table.join(plan, "list").withColumn("block", key("id", "blocks")).withColumn("part", every("parts"))
    visits = visits.join(plan, "list").withColumn("part", key("asked", "parts")).withColumn("block", every("blocks"))
    cell = ["list", "block", "part"]
    kind = index.table.schema["id"].dataType
    schema = T.StructType([T.StructField("asked", kind), T.StructField("id", kind),
                           T.StructField("distance", T.DoubleType())])
    return rows.drop("blocks", "parts").groupBy(*cell).cogroup(visits.drop("blocks", "parts").groupBy(*cell)).applyInArrow(
        _scanned(index.shared, keep, error), schema)


def _best(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("asked").orderBy("distance", "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)


def _homes(shared: Broadcast, dims: int):
    def run(batches):
        for batch in batches:
            if len(batch):
                own = _closest(_rows(batch.column(1), dims).astype(np.float64), shared.value.centres)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], ["asked", "vec", "list"])
    return run


def _within(shared: Broadcast, radii: np.ndarray, dims: int):
    """The lists other than its own that can hold a vector within a query's bound."""
    def run(batches):
        centres = shared.value.centres
        for batch in batches:
            step = max(1, STEP_BYTES // (8 * len(centres)))
            for low in range(0, len(batch), step):
                part = batch.slice(low, step)
                rows = _rows(part.column(1), dims).astype(np.float64)
                square = (rows**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1) - 2 * rows @ centres.T
                near = np.sqrt(np.maximum(square, 0)) - radii <= part.column(3).to_numpy()[:, None] + 1e-6
                near[np.arange(len(rows)), part.column(2).to_numpy()] = False
                at, to = np.nonzero(near)
                taken = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [taken.column(0), taken.column(1), pa.array(to.astype(np.int32)), taken.column(3)],
                    ["asked", "vec", "list", "bound"])
    return run


def nearest(index: Index | None, queries: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding",
            k: int = 10, error: float = 3.0) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest indexed vectors of other ids for each query row.

    Nearest first by Euclidean distance in double precision, equal ones by id; all if there are fewer than
    ``k``. Queries that are null, without an id, zero, not finite or of another length than the index
    get no row; neither does any query where the index is None. Repeated query rows are one, as are
    repeated indexed rows. Ids are taken to be unique: different vectors of one id are
    candidates each, and none of them for a query of that id. Other columns are not looked at.
    """
    spark = shipped(queries.sparkSession)
    kind = queries.schema[id_col].dataType
    if index is None:
        return spark.createDataFrame([], T.StructType([
            T.StructField("query_id", kind), T.StructField("rank", T.IntegerType()), T.StructField("vec_id", kind),
            T.StructField("score", T.DoubleType())]))
    rows = staged(usable(queries, id_col, vec_col).where(F.size("vec") == index.dims).distinct(), "queries")
    own = rows.groupBy("vec").agg(F.min("id").alias("asked")).select("asked", "vec")
    homes = staged(own.mapInArrow(_homes(index.shared, index.dims), T.StructType(
        [*own.schema.fields, T.StructField("list", T.IntegerType())])), "homes")
    wide = float("inf")
    first = staged(_best(_scan(index, homes.withColumn("bound", F.lit(wide)), k + 1, error), k + 1), "near")
    bounds = first.groupBy("asked").agg(
        F.when(F.count("*") > k, F.max("distance")).otherwise(wide).alias("bound"))
    bounded = homes.join(bounds, "asked", "left").withColumn("bound", F.coalesce("bound", F.lit(wide)))
    visits = staged(bounded.mapInArrow(_within(index.shared, index.radii, index.dims), T.StructType(
        [*homes.schema.fields, T.StructField("bound", T.DoubleType())])), "visits")
    more = _scan(index, visits, k + 1, error)
    found = staged(_best(first.drop("place").union(more), k + 1).drop("place"), "found")
    # equal vectors take little of a file too
    named = rows.join(own.withColumnRenamed("vec", "same").hint("merge"), F.col("vec") == F.col("same")).select(
        F.col("id").alias("query_id"), "asked")
    ranked = Window.partitionBy("query_id", "asked").orderBy("distance", "id")
    return named.join(found, "asked").where("query_id != id").withColumn(
        "rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"),
        F.col("distance").alias("score"))
