"""A journal of what batches left behind: one published folder per batch id, made at most once.

Work writes into a folder of its own; a single rename publishes it under its batch id. A batch that comes again - after a lost
driver, or because a stream replays its last batch - finds its folder and does nothing.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession

_NOTE = "note.json"


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def published(spark: SparkSession, root: str) -> list[int]:
    """Batch ids with a published version, ascending."""
    folder, fs = _files(spark, root)
    if not fs.exists(folder):
        return []
    found = (re.fullmatch(r"batch=(\d+)", s.getPath().getName()) for s in fs.listStatus(folder))
    return sorted(int(m[1]) for m in found if m)


def version_path(root: str, batch_id: int) -> str:
    return f"{root}/batch={batch_id}"


def latest(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest published version."""
    ids = published(spark, root)
    return version_path(root, ids[-1]) if ids else None


def note(spark: SparkSession, root: str, batch_id: int) -> dict[str, Any]:
    """What the work of a published batch returned."""
    text = spark.read.text(f"{version_path(root, batch_id)}/{_NOTE}", wholetext=True).first()
    return json.loads(text[0])


def once(spark: SparkSession, root: str, batch_id: int, work: Callable[[str], dict[str, Any]]) -> tuple[dict[str, Any], bool]:
    """``work(folder)`` unless the batch has a version already; its note, and whether the work was done now.

    What an interrupted run wrote stays unpublished. Of two runs at the same time the first to rename wins, and the other
    one's folder is removed. The rename has to be atomic, as on HDFS and local disks.
    """
    if batch_id in published(spark, root):
        return note(spark, root, batch_id), False
    staged = f"{root}/_staged-{uuid.uuid4().hex}"
    said = work(staged)
    folder, fs = _files(spark, staged)
    fs.mkdirs(folder)
    out = fs.create(_files(spark, f"{staged}/{_NOTE}")[0], True)
    out.write(bytearray(json.dumps(said).encode()))
    out.close()
    target = _files(spark, version_path(root, batch_id))[0]
    if fs.exists(target) or not fs.rename(folder, target):
        fs.delete(folder, True)
        return note(spark, root, batch_id), False
    return said, True
