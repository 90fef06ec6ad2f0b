"""Shared helpers of the training-data operators.

Python runs only inside Arrow-batched tasks that Spark partitions; the helpers
here carry the columns a caller keeps through such a task and append one struct
column under a name the input does not use, so extra columns with any name
(also the names of results) survive untouched.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyspark.session import scratch_path

DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED = "_tidyspark_shipped"
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors once per session (as ``--py-files`` would).

    Also bounds Arrow batches: texts may be long, so a batch has at most ``BATCH_ROWS`` rows.
    """
    if int(spark.conf.get(BATCH_SETTING)) > BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    sc = spark.sparkContext
    if getattr(sc, _SHIPPED, False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tidyspark-code-"), "tidyspark_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    setattr(sc, _SHIPPED, True)


def write_stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back (cuts lineage)."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that no later step reads."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jvm_path, True)


def fresh_name(df: DataFrame, stem: str) -> str:
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = f"{stem}_{uuid.uuid4().hex[:6]}"
    return name


def broadcast_value(spark: SparkSession, value):
    """A read-only value for tasks. Callers state its size bound."""
    return spark.sparkContext.broadcast(value)


def content_key(*parts) -> str:
    """A key for ``worker_cached`` that differs when the contents do: bytes, texts, numbers, or lists of these."""
    digest = hashlib.sha256()

    def add(x):
        if isinstance(x, (list, tuple)):
            digest.update(b"[%d]" % len(x))
            for y in x:
                add(y)
            return
        data = x if isinstance(x, bytes) else x.tobytes() if isinstance(x, np.ndarray) else str(x).encode()
        digest.update(b"%d:" % len(data) + data)
    add(parts)
    return digest.hexdigest()


_WORKER: dict = {}


def worker_cached(key, make: Callable):
    """One object per key in a Python worker; the least recently made goes beyond two."""
    if key not in _WORKER:
        while len(_WORKER) >= 2:
            _WORKER.pop(next(iter(_WORKER)))
        _WORKER[key] = make()
    return _WORKER[key]


class Memo(dict):
    """A bounded memo: computes a missing value, starts afresh beyond ``limit`` entries."""

    def __init__(self, compute: Callable, limit: int = 100_000):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.compute(key)
        return value


def text_slices(batch: pa.RecordBatch, column: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows holding at most ``most_bytes`` of text (one row at least)."""
    col = batch.column(batch.schema.get_field_index(column))
    n = batch.num_rows
    if n == 0:
        return
    sizes = np.nan_to_num(np.array(pc.binary_length(col).to_pylist(), dtype=float))
    ends = np.cumsum(sizes)
    start = 0
    while start < n:
        base = ends[start - 1] if start else 0.0
        stop = max(start + 1, int(np.searchsorted(ends, base + most_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def append_struct(df: DataFrame, text: str, fields: T.StructType, per_texts: Callable,
                  keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """Keep columns ``keep`` (default: all) and append one struct column.

    ``per_texts(list of str or None)`` returns one list per field of ``fields``; it is
    called on slices of an Arrow batch, never on a whole partition. Returns
    the frame and the struct column's name.
    """
    ship_code(df.sparkSession)
    keep = list(df.columns) if keep is None else list(keep)
    out = fresh_name(df, "llm_out")
    probe = fresh_name(df, "llm_text")
    picked = df.select(*[df[c] for c in keep], df[text].alias(probe))
    schema = T.StructType([picked.schema[c] for c in keep] + [T.StructField(out, fields)])
    names = [f.name for f in fields.fields]

    def run(batches):
        for whole in batches:
            for b in text_slices(whole, probe):
                texts = b.column(len(keep)).to_pylist()
                columns = per_texts(texts)
                kept = [b.column(i) for i in range(len(keep))]
                types = [arrow_type(f.dataType) for f in fields.fields]
                arrays = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)]
                struct = pa.StructArray.from_arrays(arrays, names=names)
                yield pa.RecordBatch.from_arrays([*kept, struct], names=[*keep, out])

    return picked.mapInArrow(run, schema), out


def arrow_type(t: T.DataType) -> pa.DataType:
    simple = {"string": pa.string(), "long": pa.int64(), "integer": pa.int32(), "double": pa.float64(),
              "float": pa.float32(), "boolean": pa.bool_(), "binary": pa.binary()}
    if isinstance(t, T.ArrayType):
        return pa.list_(arrow_type(t.elementType))
    return simple[t.typeName()]


def crc_mod(column, k: int):
    """crc32 of the value as text, modulo ``k`` (null ids count as empty text)."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % k


def sampled(df: DataFrame, key: str, most_rows: int, n_rows: int | None = None, salt: int = 0) -> DataFrame:
    """About ``most_rows`` rows chosen by a hash of ``key``: the same rows in every run."""
    n = df.count() if n_rows is None else n_rows
    if n <= most_rows:
        return df
    cut = int(most_rows / n * (1 << 30))
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit(salt)), F.lit(1 << 30)) < cut)


def whole_chunks(text: str, size: int = 1 << 20) -> Iterator[str]:
    """Cut a very long text where a non-space meets a space, which no token or word crosses."""
    start, n = 0, len(text)
    while n - start > size:
        cut = start + size
        while cut < n and not (text[cut].isspace() and not text[cut - 1].isspace()):
            cut += 1
        yield text[start:cut]
        start = cut
    yield text[start:]
