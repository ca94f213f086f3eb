"""The few file-system calls that commit markers and the ledger need, through Spark's own Hadoop file systems."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import SparkSession

from exactsync.errors import SyncError


def _path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _path(spark, path)
    return fs.exists(jpath)


def create_json(spark: SparkSession, path: str, content: dict) -> bool:
    """Publish a small file, whole or not at all, unless it exists; False if another writer was first.

    The content is written under a temporary name first, so a crash leaves no torn file. On a local file
    system a hard link publishes it, elsewhere a rename that refuses to replace, which HDFS does atomically.
    Object stores without such a rename are not supported for markers and ledger.
    """
    jpath, fs = _path(spark, path)
    data = json.dumps(content, sort_keys=True).encode("utf-8")
    if fs.getScheme() == "file":
        return _publish_local(jpath.toUri().getPath(), data)
    if fs.exists(jpath):
        return False
    draft = spark._jvm.org.apache.hadoop.fs.Path(jpath.getParent(), f".{jpath.getName()}.{uuid.uuid4()}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(jpath.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = getattr(hadoop, "Options$Rename").NONE
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(jpath), options)
    except Exception:
        fs.delete(draft, False)
        if fs.exists(jpath):
            return False
        raise
    return True


def _publish_local(path: str, data: bytes) -> bool:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    draft = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.{uuid.uuid4()}")
    with open(draft, "xb") as out:
        out.write(data)
        out.flush()
        os.fsync(out.fileno())
    try:
        os.link(draft, path)
    except FileExistsError:
        return False
    finally:
        os.unlink(draft)
    return True


def read_json(spark: SparkSession, path: str) -> dict:
    """Content of a small published file; it is never half written, so one that does not parse is damaged."""
    jpath, fs = _path(spark, path)
    stream = fs.open(jpath)
    try:
        size = fs.getFileStatus(jpath).getLen()
        return json.loads(bytes(stream.readNBytes(int(size))).decode("utf-8"))
    except ValueError as e:
        raise SyncError("STATE_STORE", f"{path} is damaged: its content is no JSON") from e
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    jpath, fs = _path(spark, folder)
    if not fs.exists(jpath):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(jpath))


def discard(spark: SparkSession, path: str) -> None:
    """Drop a staging folder of the engine's own."""
    jpath, fs = _path(spark, path)
    fs.delete(jpath, True)
