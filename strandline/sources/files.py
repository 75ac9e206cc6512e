"""Files by path on the driver and in tasks: local, or of any file system that pyarrow opens (hdfs, s3, gs).

A path without a scheme, or with ``file:``, is a path that driver and executors
share. Whole files are never held: digests and copies go by chunks.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 1 << 22


def ship(spark: SparkSession) -> None:
    """Put the folder of this package on the Python path of workers that the session starts on this machine.

    On a cluster the package is installed on every node or sent with ``--py-files``.
    """
    here = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if here not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (here, env.get("PYTHONPATH", "")) if x)


def located(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


def absolute(path: str) -> str:
    """The path as it may be written down: local ones from the root, others as they are."""
    return path if "://" in path and not path.startswith("file:") else located(path)[1]


def is_local(path: str) -> bool:
    return isinstance(located(path)[0], fs.LocalFileSystem)


def opened(path: str) -> pa.NativeFile:
    """The file for reading, with ``seek``."""
    system, name = located(path)
    return system.open_input_file(name)


def size_of(path: str) -> int | None:
    """Bytes of a file; None if there is none."""
    system, name = located(path)
    told = system.get_file_info(name)
    return told.size if told.type == fs.FileType.File else None


def is_older(path: str, other: str) -> bool:
    """Whether ``path`` was last changed before ``other``."""
    times = [system.get_file_info(name).mtime_ns for system, name in map(located, (path, other))]
    return times[0] is not None and times[1] is not None and times[0] < times[1]


def make_folder(path: str) -> None:
    system, name = located(path)
    system.create_dir(name, recursive=True)


def remove(path: str) -> None:
    """Delete a file or a folder with all in it, if it is there."""
    system, name = located(path)
    kind = system.get_file_info(name).type
    if kind == fs.FileType.File:
        system.delete_file(name)
    elif kind == fs.FileType.Directory:
        system.delete_dir(name)


def rename(old: str, new: str) -> None:
    """Give a complete file its name; readers see the old file or the new one."""
    system, name = located(old)
    if isinstance(system, fs.LocalFileSystem):
        os.replace(name, located(new)[1])
    else:
        system.move(name, located(new)[1])


def parent(path: str) -> str:
    return path.rpartition("/")[0] or ("/" if path.startswith("/") else ".")


def beside(path: str) -> str:
    """A hidden name in the same folder that nothing else has."""
    folder, _, name = path.rpartition("/")
    return f"{folder}{'/' if folder or path.startswith('/') else ''}.{name}.{uuid.uuid4().hex}"


def read_text(path: str) -> str:
    with opened(path) as file:
        return file.read().decode()


def write_bytes(path: str, chunks: Iterable[bytes]) -> None:
    """A small file, complete or not there: written under another name, flushed and renamed."""
    make_folder(parent(path))
    system, name = located(other := beside(path))
    try:
        with system.open_output_stream(name) as out:
            for chunk in chunks:
                out.write(chunk)
        if isinstance(system, fs.LocalFileSystem):
            with open(name, "rb+") as file:
                os.fsync(file.fileno())
        rename(other, path)
    except BaseException:
        remove(other)
        raise


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only in a local session that doesn't set it."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = Path(tempfile.mkdtemp(prefix="strandline-")).as_uri()
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: its lineage ends here."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chunks_of(path: str) -> Iterator[bytes]:
    with opened(path) as file:
        while block := file.read(CHUNK):
            yield block


def sha256_of(path: str) -> str:
    digest = hashlib.sha256()
    for block in chunks_of(path):
        digest.update(block)
    return digest.hexdigest()


def digests(paths: DataFrame, hashed: bool = True) -> DataFrame:
    """path, bytes and, if ``hashed``, sha256 of every distinct path of ``paths`` (path); null where there is no file.

    A task streams a file by chunks; files are spread over all tasks.
    """
    ship(paths.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                n = size_of(path)
                yield pa.RecordBatch.from_pylist([{"path": path, "bytes": n, "sha256": sha256_of(path) if hashed and n is not None else None}], schema=DIGEST)

    each = paths.select(F.col("path").cast("string")).where("path is not null").distinct()
    return each.repartition(max(2, paths.sparkSession.sparkContext.defaultParallelism), "path").mapInArrow(read, "path string, bytes long, sha256 string")


def digests_of(spark: SparkSession, paths: list[str]) -> dict[str, tuple[int | None, str | None]]:
    """Bytes and sha256 of a list of files, by path; a task streams a file."""
    ship(spark)
    paths = sorted(set(paths))
    if not paths:
        return {}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in (paths[i] for i in batch.column(0).to_pylist()):
                n = size_of(path)
                yield pa.RecordBatch.from_pylist([{"path": path, "bytes": n, "sha256": None if n is None else sha256_of(path)}], schema=DIGEST)

    rows = spark.range(0, len(paths), 1, min(len(paths), 4 * spark.sparkContext.defaultParallelism)).mapInArrow(read, "path string, bytes long, sha256 string")
    return {r["path"]: (r["bytes"], r["sha256"]) for r in rows.collect()}


DIGEST = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("sha256", pa.string())])
