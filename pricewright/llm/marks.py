"""One bit for each row of a table, brought to the rows where they lie.

A join on an id moves every text. Here a row is known by the Parquet file it is read from and its
position in it, the same in every scan; the marked positions of a file become bitmaps of 32,768
rows, 4 kB each, which are sent to every task. That is one bit a row, and 4 kB a file at least.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from pricewright.staging import staged

#: file (a digest of its path) and position
FILE, ROW = "__file", "__at"
PLACE = (FILE, ROW)
_BUCKET, _BITS, _ROWS = "__bucket", "__bits", 32768


def _with_place(docs: DataFrame) -> DataFrame:
    source = docs.metadataColumn("_metadata")
    return docs.select("*", F.xxhash64(source["file_path"]).alias(FILE), source["row_index"].alias(ROW))


def placed(docs: DataFrame) -> DataFrame:
    """The rows with their place. What is more than Parquet files as they are is written first."""
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        try:
            return _with_place(docs)
        except AnalysisException:
            pass  # files of another kind
    return _with_place(staged(docs, "placed"))


def with_mark(rows: DataFrame, chosen: DataFrame, name: str) -> DataFrame:
    """Placed rows without their place, and in ``name`` whether it is among the places ``chosen``."""
    bucket = (F.floor(F.col(ROW) / _ROWS)).cast("long").alias(_BUCKET)
    at = F.pmod(F.col(ROW), F.lit(_ROWS))
    # by bucket before they are added up: a bitmap in the making is 4 kB however few its rows are
    maps = staged(chosen.select(FILE, bucket, at.alias(ROW)).repartition(FILE, _BUCKET).groupBy(FILE, _BUCKET).agg(
        F.bitmap_construct_agg(ROW).alias(_BITS)), "marks")
    byte = F.conv(F.hex(F.substring(_BITS, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    mark = F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1
    return (rows.withColumn(_BUCKET, bucket).join(F.broadcast(maps), [FILE, _BUCKET], "left")
            .withColumn(name, F.coalesce(mark, F.lit(False))).drop(FILE, ROW, _BUCKET, _BITS))
