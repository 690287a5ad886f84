"""Session-level helpers: the shared work folder, written intermediate tables, size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 200_000
_own_dirs: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` as the cluster names it.

    Only a local master may go without it; it then gets one fresh temporary folder per application.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    already = spark.sparkContext.getCheckpointDir()
    if already:
        return already
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="premia-")
    return _own_dirs[app]


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh path under the shared folder that `drop_written` removes."""
    path = f"{shared_dir(spark)}/premia-{kind}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as parquet under the shared folder and read it back.

    Cuts the lineage like a checkpoint, survives lost executors, keeps column pruning, and gives the
    optimizer true file sizes, so that it only broadcasts what it has measured.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop(*tables: DataFrame) -> None:
    """Remove the written tables among ``tables`` (what `materialize` returned), once no frame built on them is read any more."""
    for table in tables:
        if path := vars(table).get("_written_at"):
            _remove(table.sparkSession, path)
            known = _written[table.sparkSession.sparkContext.applicationId]
            known[:] = [p for p in known if p != path]


def written(spark: SparkSession) -> list[str]:
    """Paths of the intermediate tables, saved trees and stream folders this application has written and not dropped, oldest first."""
    return list(_written.get(spark.sparkContext.applicationId, []))


def drop_written(spark: SparkSession, keep: Iterable[str] = ()) -> int:
    """Remove what `written` lists, but for the paths of ``keep``; returns how many there were.

    Call it when no frame built on them will be read any more.
    """
    kept, known = set(keep), written(spark)
    paths = [p for p in known if p not in kept]
    _written[spark.sparkContext.applicationId] = [p for p in known if p in kept]
    for path in paths:
        _remove(spark, path)
    return len(paths)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each query run inside are removed when it ends, not when the driver next collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only if ``df`` is counted to hold at most ``max_rows`` rows; else the plain frame.

    Meant for written tables (`materialize`), whose count reads nothing but parquet footers.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def spread(scan: DataFrame) -> DataFrame:
    """A plain table scan redistributed over all cores if its files give fewer partitions than there are cores.

    For row-local heavy work (tokenising, mining) on few unsplittable files. A large table has far more
    partitions than cores and is returned as it is. Call it on scans only: looking at partitions plans the frame.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
