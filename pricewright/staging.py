"""Tables written between stages, in a folder every executor can reach.

Writing a table cuts lineage in a way that survives lost executors, and reading
it back gives Catalyst real file sizes: a small staged side is broadcast because
its size is known, a large one is not.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only in local mode."""
    base = spark.conf.get(_CONF, None)
    if base:
        return base.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError(f"set {_CONF} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="pricewright-")
    return _LOCAL[app]


def _app_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/pricewright/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A path no earlier stage has used."""
    return f"{_app_dir(spark)}/{label}-{uuid.uuid4().hex}"


def drop_stages(spark: SparkSession) -> None:
    """Delete every stage table of this application; frames that read them are void after it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_app_dir(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


#: a row group is the least a task reads
ROW_GROUP_BYTES = 16 << 20


#: shuffle files go when a write is over, not when the driver happens to collect its garbage; nothing runs a write again
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_stage(df: DataFrame, path: str, mode: str = "error") -> None:
    """A stage table: small on disk, in pieces small enough that a task can hold the rows of one."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        df.write.mode(mode).option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    finally:
        conf.set(_CLEANUP, before) if before is not None else conf.unset(_CLEANUP)


def write_pieces(pieces: Iterable[DataFrame], path: str) -> None:
    """One stage table of several frames, written one after the other: only one's shuffles are on disk at a time."""
    for piece in pieces:
        write_stage(piece, path, "append")


#: slices of a large table, and bytes of its files in one at least
SLICES, SLICE_BYTES = 8, 16 << 20


def slices(size: int) -> int:
    """Into how many slices a table of so many bytes is cut for a step that shuffles whole rows."""
    return max(1, min(SLICES, size // SLICE_BYTES))


def read_bytes(df: DataFrame) -> int:
    """Bytes of the columns a frame reads from files, as the optimizer has them; 0 for one that is not read from files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) if df.inputFiles() else 0


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """Materialise ``df`` once and continue from the written table."""
    return staged_pieces([df], label, df)


def staged_pieces(pieces: Iterable[DataFrame], label: str, like: DataFrame) -> DataFrame:
    """``staged`` for frames that make up one table with the columns of ``like``."""
    path = new_path(like.sparkSession, label)
    write_pieces(pieces, path)
    return like.sparkSession.read.schema(like.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """At least one partition per core for CPU-bound passes over a small table.

    A table that already has as many partitions as the cluster has cores is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def in_parallel(spark: SparkSession, tasks: Sequence[Callable], parallelism: int) -> list:
    """Results of driver-side tasks that each run distributed jobs, several at a time."""
    in_session = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return [f.result() for f in [pool.submit(in_session(t)) for t in tasks]]


def source_fingerprint(df: DataFrame, *facts: object) -> str:
    """Digest of the files a table is read from (path, length, time of change) and of whatever else decides a stage."""
    spark = df.sparkSession
    files = sorted(df.inputFiles())
    if not files:
        raise ValueError("only a table that is read from files can be told from another one")
    digest = hashlib.sha256(repr(facts).encode())
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    listed: dict[str, dict[str, tuple[int, int]]] = {}
    for file in files:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        folder = path.getParent().toString()
        if folder not in listed:
            listed[folder] = {s.getPath().getName(): (s.getLen(), s.getModificationTime())
                              for s in path.getFileSystem(conf).listStatus(path.getParent())}
        digest.update(f"{file} {listed[folder].get(path.getName())}\n".encode())
    return digest.hexdigest()[:24]


class Stages:
    """Stage tables and models that outlive the run, so that a run that died goes on behind its last finished stage.

    A stage is kept under its label and the fingerprint of everything that decides it. It is written to a folder of the
    writer's own and moved into place whole; what has a name is therefore finished.
    """

    def __init__(self, spark: SparkSession, folder: str, fingerprint: str):
        self.spark, self.folder, self.fingerprint = spark, folder.rstrip("/"), fingerprint

    def _kept(self, label: str, write: Callable[[str], None]) -> str:
        path = f"{self.folder}/{label}-{self.fingerprint}"
        place = lambda p: self.spark._jvm.org.apache.hadoop.fs.Path(p)
        files = place(path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(place(path)):
            own = f"{self.folder}/_unfinished/{label}-{uuid.uuid4().hex}"
            write(own)
            # another run may have finished the same stage meanwhile: theirs is as good
            if not files.rename(place(own), place(path)) and not files.exists(place(path)):
                raise OSError(f"'{own}' could not be moved to '{path}'")
        return path

    def done(self, label: str) -> bool:
        """Was the label marked by an earlier run of the same input."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{label}-{self.fingerprint}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def mark(self, label: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{label}-{self.fingerprint}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)

    def table(self, label: str, build: Callable[[], DataFrame]) -> DataFrame:
        return self.spark.read.parquet(self._kept(label, lambda path: write_stage(build(), path)))

    def model(self, label: str, build: Callable[[], PipelineModel]) -> PipelineModel:
        return PipelineModel.load(self._kept(label, lambda path: build().write().save(path)))
