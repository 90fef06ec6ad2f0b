"""Stored keyed tables whose state changes in one step: replace, concurrent merges, replayed batches.

A table is a folder of plain parquet folders, each written once by Spark and
never changed, and of numbered pointer files:

    <path>/data/__batch=<name>/  rows
    <path>/versions/0000000007   which data folders are version 7, and the largest key

A reader takes the highest pointer; the frame it gets names its folders, so it
reads the same rows whatever is published later. A writer writes its rows to a
new data folder first and then creates the next pointer, which succeeds only
if nobody else has created that number. A writer that ends before that step changes nothing;
its folder is never listed and ``clean`` deletes it later.

* ``replace`` publishes a version that lists only the new rows' folder.
* ``merge`` adds the rows whose natural key is not stored yet, numbered after
  the pointer's largest key (no scan for a maximum). If another writer published meanwhile, the
  new rows are compared again with the rows of the added folders only, numbered anew
  and published after them, so no natural key and no surrogate key is stored twice.
* With ``buckets`` the rows are partitioned by a hash of their natural key, and
  a merge reads only the buckets that its batch has (Spark's partition pruning).
* A batch may carry a number in a named sequence (a stream's micro-batch). The
  pointer keeps the last number of each sequence, so a batch that comes again
  is known by one small read, without a look at the stored keys.

A pointer lists one folder for each merge since the last replace; ``compact``
makes one of them again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyspark.operators.keys import dense_key
from tidyspark.operators.merge import distinct_batch, max_key, unmatched
from tidyspark.session import materialize
from tidyspark.sources.files import age_seconds, create_if_absent, delete, list_names, read_text

BATCH, BUCKET = "__batch", "__bucket"          # partition columns of the data folders


@dataclass(frozen=True)
class Version:
    """What one pointer file says."""

    number: int = 0
    folders: tuple[str, ...] = ()
    schema: str = ""                     # of the rows, as Spark's JSON
    largest_key: int = 0
    buckets: int = 0
    bucket_by: tuple[str, ...] = ()
    batches: dict = field(default_factory=dict)      # last batch of each sequence

    def text(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def parse(text: str) -> Version:
        v = json.loads(text)
        return Version(**{**v, "folders": tuple(v["folders"]), "bucket_by": tuple(v["bucket_by"])})


class StoredTable:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 0):
        """``buckets``: of a table that does not exist yet; a stored one keeps its own."""
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    # -- reading ---------------------------------------------------------------------

    def version(self, number: int | None = None) -> Version | None:
        """The pointer of that number, or the highest; None if there is none."""
        folder = f"{self.path}/versions"
        if number is None:
            names = [n for n in list_names(self.spark, folder) if n.isdigit()]
            if not names:
                return None
            number = int(names[-1])
        return Version.parse(read_text(self.spark, f"{folder}/{number:010d}"))

    def _rows(self, version: Version, folders=None) -> DataFrame:
        """The version's rows with their bucket column, if they have one."""
        schema = T.StructType.fromJson(json.loads(version.schema)).add(BATCH, T.StringType())
        if version.buckets:
            schema = schema.add(BUCKET, T.IntegerType())
        folders = version.folders if folders is None else folders
        if not folders:
            return self.spark.createDataFrame([], schema).drop(BATCH)
        return (self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
                .parquet(*[f"{self.path}/data/{f}" for f in folders]).drop(BATCH))

    def read(self, number: int | None = None) -> DataFrame | None:
        """The rows of a version (default: the highest), or None if there is no table."""
        v = self.version(number)
        return None if v is None else self._rows(v).drop(BUCKET)

    def added(self, since: int) -> DataFrame | None:
        """Rows of the highest version in folders that version ``since`` (0: none) does not have; None if none."""
        new, old = self.version(), self.version(since) if since else Version()
        folders = [f for f in new.folders if f not in set(old.folders)] if new else []
        return self._rows(new, folders).drop(BUCKET) if folders else None

    # -- writing ---------------------------------------------------------------------

    def _write(self, rows: DataFrame, version: Version) -> str:
        name = f"{BATCH}={uuid.uuid4().hex}"
        target = f"{self.path}/data/{name}"
        if version.buckets:
            bucket = F.pmod(F.xxhash64(*version.bucket_by), F.lit(version.buckets)).cast("int")
            rows = rows.withColumn(BUCKET, bucket)
            # one task writes a bucket; a batch is dealt by bucket once, stored rows are not
            rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(target)
        else:
            rows.write.parquet(target)
        return name

    def _publish(self, version: Version) -> bool:
        return create_if_absent(self.spark, f"{self.path}/versions/{version.number:010d}", version.text())

    def _blank(self, rows: DataFrame, natural_key, base: Version | None) -> Version:
        """The next version, without rows yet."""
        buckets = base.buckets if base else self.buckets
        by = base.bucket_by if base and base.bucket_by else tuple(natural_key or ())
        if buckets and not by:
            raise ValueError("a table in buckets needs its natural key")
        return Version(base.number + 1 if base else 1, (), _nullable(rows.schema).json(), 0, buckets, by,
                       dict(base.batches) if base else {})

    def replace(self, rows: DataFrame, key: str | None = None, natural_key=None,
                before_publish: Callable[[], None] | None = None) -> int:
        """Publish a version of just ``rows`` (they keep the numbers in ``key``); its number.

        Frames read before go on reading the old rows; rows merged by others meanwhile are replaced too.
        """
        natural_key = _names(natural_key)
        base = self.version()
        new = self._blank(rows, natural_key, base)
        folder = self._write(rows, new)
        new = replace(new, folders=(folder,))
        if key is not None:
            new = replace(new, largest_key=max_key(self._rows(new), key))
        if before_publish:
            before_publish()
        while not self._publish(new):
            base = self.version()
            new = replace(new, number=base.number + 1, batches=base.batches,
                          largest_key=max(new.largest_key, 0))
        return new.number

    def merge(self, batch: DataFrame, natural_key, key: str | None = None, order_by=None,
              sequence: str | None = None, batch_number: int | None = None,
              before_publish: Callable[[], None] | None = None) -> int:
        """Add the rows whose natural key is not stored; how many were added.

        ``key`` is the surrogate key's name: new rows are numbered from the largest on, in the order of ``order_by``
        (default: the natural key). ``sequence`` and ``batch_number`` name a batch that may come again: one
        with a number not over the sequence's last is left out. ``before_publish`` is called
        once, when the rows are written and not yet published.
        """
        natural_key = _names(natural_key)
        order_by = natural_key if order_by is None else _names(order_by)
        base = self.version()
        if self._seen(base, sequence, batch_number):
            return 0
        if base is not None:
            stored = T.StructType.fromJson(json.loads(base.schema))
            batch = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in stored if f.name != key])
        batch = distinct_batch(batch, natural_key)
        fresh = batch if base is None else unmatched(self._known(base, base.folders, batch, natural_key),
                                                     batch, natural_key)
        fresh = materialize(fresh, "store-fresh")
        while True:
            n, new = self._numbered(fresh, natural_key, key, order_by, base)
            if sequence is not None:
                new.batches[sequence] = batch_number
            if before_publish:
                before_publish()
                before_publish = None
            if (n == 0 and base is not None and sequence is None) or self._publish(new):
                return n
            if n:
                delete(self.spark, f"{self.path}/data/{new.folders[-1]}")
            held, base = base, self.version()
            if self._seen(base, sequence, batch_number):
                return 0
            before = held.folders if held else ()
            appended = base.folders[:len(before)] == before
            # only what came since is compared, unless the table was replaced
            since = base.folders[len(before):] if appended else base.folders
            rows = fresh if appended else batch
            fresh = materialize(unmatched(self._known(base, since, rows, natural_key), rows, natural_key),
                                "store-fresh")

    def append(self, rows: DataFrame, sequence: str, batch_number: int) -> bool:
        """Add all rows of a numbered batch, unless it was added before; whether they were."""
        folder = None
        while True:
            base = self.version()
            if self._seen(base, sequence, batch_number):
                if folder:
                    delete(self.spark, f"{self.path}/data/{folder}")
                return False
            new = self._blank(rows, base.bucket_by if base else (), base)
            folder = folder or self._write(rows, new)
            new.batches[sequence] = batch_number
            if self._publish(replace(new, folders=(base.folders if base else ()) + (folder,),
                                     largest_key=base.largest_key if base else 0)):
                return True

    @staticmethod
    def _seen(version: Version | None, sequence: str | None, number: int | None) -> bool:
        return bool(version and sequence is not None and number <= version.batches.get(sequence, -1))

    def _known(self, version: Version, folders, batch: DataFrame, natural_key: list[str]) -> DataFrame:
        """Stored rows that the batch may hold: of a table in buckets only those buckets."""
        rows = self._rows(version, folders)
        if not version.buckets:
            return rows
        if set(version.bucket_by) != set(natural_key):
            raise ValueError(f"the table is in buckets by {version.bucket_by}")
        bucket = F.pmod(F.xxhash64(*version.bucket_by), F.lit(version.buckets)).cast("int")
        wanted = [r[0] for r in batch.select(bucket.alias("b")).distinct().collect()]    # at most ``buckets`` numbers
        return rows.where(F.col(BUCKET).isin(wanted)).drop(BUCKET)

    def _numbered(self, fresh: DataFrame, natural_key, key, order_by, base: Version | None) -> tuple[int, Version]:
        """Write the new rows with keys after the base's; their number and the version that has them."""
        n = fresh.count()                # from parquet metadata
        start = base.largest_key if base else 0
        rows = fresh
        if base is not None and not n:
            return 0, replace(base, number=base.number + 1, batches=dict(base.batches))
        if key is not None:
            rows = dense_key(fresh, order_by, key, start=start, unique=True)
            rows = rows.select(*([f.name for f in T.StructType.fromJson(json.loads(base.schema))] if base
                                 else [key, *fresh.columns]))
        new = self._blank(rows, natural_key, base)
        return n, replace(new, folders=(base.folders if base else ()) + (self._write(rows, new),),
                          largest_key=start + n if key is not None else start)

    def compact(self, key: str | None = None) -> int:
        """One folder again for all rows of the highest version; stops if another writer publishes meanwhile."""
        base = self.version()
        rows = self._rows(base).drop(BUCKET)
        new = self._blank(rows, base.bucket_by, base)
        new = replace(new, folders=(self._write(rows, new),), largest_key=base.largest_key)
        if not self._publish(new):
            delete(self.spark, f"{self.path}/data/{new.folders[0]}")
            raise RuntimeError("another writer published a version; compact again")
        return new.number

    def clean(self, keep: int = 2, least_age: float = 86_400) -> int:
        """Delete all but the ``keep`` highest pointers and unlisted folders of at least that age in seconds."""
        names = [n for n in list_names(self.spark, f"{self.path}/versions") if n.isdigit()]
        kept = [self.version(int(n)) for n in names[-keep:]]
        for n in names[:-keep]:
            delete(self.spark, f"{self.path}/versions/{n}")
        listed = {f for v in kept for f in v.folders}
        old = [f for f in list_names(self.spark, f"{self.path}/data") if f not in listed
               and age_seconds(self.spark, f"{self.path}/data/{f}") >= least_age]
        for f in old:
            delete(self.spark, f"{self.path}/data/{f}")
        return len(old)


def _names(columns) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns or ())


def _nullable(schema: T.StructType) -> T.StructType:
    """As parquet reads it back."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema if f.name != BUCKET])
