"""Helpers shared by the corpus operators: tables written once to the shared
folder, files read and written by tasks there, and small byte-level parts.

Files that Python tasks write or read live under the folder named by
``spark.checkpoint.dir`` and are opened through ``pyarrow.fs``, so ``file:``,
``hdfs:``, ``s3:`` and ``gs:`` folders all work.  A task attempt writes under
a name of its own and only the names returned by the *successful* attempt are
recorded (in a table that Spark commits), so a lost executor or a speculative
attempt leaves at most an unreferenced file.
"""

from __future__ import annotations

import sys
import types
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.session import scratch_path

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# characters that separate words: space and tab .. carriage return
WORD = r"[^\x20\x09-\x0D]+"


def ship(name: str) -> None:
    """Send the functions of module ``name`` to the executors by value, so
    they need no copy of this package on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


def task_cache() -> dict:
    """A dict that lives as long as the Python worker process."""
    mod = sys.modules.get("_rankflow_task_cache")
    if mod is None:
        mod = sys.modules["_rankflow_task_cache"] = types.ModuleType("_rankflow_task_cache")
        mod.items = {}
    return mod.items


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` computed once: written as parquet to the shared folder and read
    back.  Cuts the lineage, survives lost executors, and lets Spark delete
    the shuffle files of the write as soon as it has been committed."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN)
        else:
            spark.conf.set(_CLEAN, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`written` that nothing reads any more."""
    for t in tables:
        jvm = t.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.written_path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def file_system(uri: str):
    """(file system, path) of a URI or plain path, for use inside tasks."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def attempt_name(suffix: str) -> str:
    """A file name that no other task attempt uses."""
    from pyspark import TaskContext

    ctx = TaskContext.get()
    part = ctx.partitionId() if ctx else 0
    return f"part-{part:06d}-{uuid.uuid4().hex[:16]}{suffix}"


def word_count(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bytes_of(column) -> list:
    """The values of an Arrow string or binary column as bytes (null: None)."""
    import pyarrow as pa

    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return column.to_pylist()


def mixed(x):
    """A strong 64-bit finaliser over a numpy uint64 array."""
    import numpy as np

    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_LONG = 4096


def hash_words(texts: list, lower: bool = False):
    """(64-bit hash of every word, its first byte, its end, words per text)
    of a list of UTF-8 texts (null: none); positions are those in the texts
    joined by single line breaks.  ``lower`` lower-cases A-Z first.

    Words are hashed together, eight bytes at a time, so no Python object is
    made for a word.
    """
    import numpy as np
    import xxhash

    joined = b"\n" + b"\n".join([t or b"" for t in texts]) + b"\n" * 9
    if lower:
        joined = joined.lower()
    data = np.frombuffer(joined, np.uint8)
    is_word = np.ones(256, bool)
    is_word[list(_SPACE)] = False
    inside = is_word[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    size = end - start
    h = mixed((size + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    eight = np.lib.stride_tricks.as_strided(data[:8].view(np.uint64), (len(data) - 7,), (1,), writeable=False)
    todo = np.flatnonzero(size <= _LONG)
    at, left = start[todo], size[todo]
    while len(todo):
        some = eight[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(8) * (8 - np.minimum(left, 8)).astype(np.uint64)))
        h[todo] = mixed((h[todo] ^ some) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    for k in np.flatnonzero(size > _LONG).tolist():
        h[k] = xxhash.xxh3_64_intdigest(joined[start[k]:end[k]])
    firsts = np.cumsum([1] + [len(t or b"") + 1 for t in texts])
    counts = np.diff(np.searchsorted(start, firsts))
    return h, start - 1, end - 1, counts


def fresh(name: str, taken) -> str:
    """``name``, with underscores before it until no column has that name."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = "_" + name
    return name


def whole_row(df: DataFrame) -> Column:
    """64-bit hash of all columns that can be hashed (no maps, no variants)."""
    return F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind])


def in_parts(texts: list, size: int = 1 << 21):
    """Slices of a list of texts (or bytes) of about ``size`` each."""
    part, held = [], 0
    for t in texts:
        part.append(t)
        held += len(t or "")
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


ship(__name__)
