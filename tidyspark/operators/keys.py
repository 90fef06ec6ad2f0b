"""Gap-free, ordered surrogate keys without a single-task sort.

``dense_key(df, order_by, name, start)`` gives every row ``start + i`` where
``i`` is its 1-based position in the ascending order of ``order_by`` (ties broken
by the remaining orderable columns), exactly like
``start + row_number() OVER (ORDER BY ...)``, but the sort is spread over many
tasks:

1. one range exchange on the ordering columns themselves and a local sort;
2. the sorted rows are written once, each with its position (partition number
   and place inside the partition) as a stored column;
3. one count per written partition gives the offsets;
4. key = start + offset of the partition + place, a pass without an exchange.

The position is evaluated once, in the job that writes it, so every later pass
sees the same one however the files are split.

Copies of one row are told apart by an arrival number, so the range exchange
may spread a group of copies that holds a large share of all rows over many
partitions. A task that is run again must give a row the same number, so the
number is taken from rows read from files: from the frame's own when it only
reads, filters and projects stored files, else from one written copy. A caller
that knows the rows to differ (``unique``: a distinct, a grouping) needs neither
number nor copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyspark.session import materialize as _materialize

_UNORDERABLE = (T.MapType, T.VariantType) if hasattr(T, "VariantType") else (T.MapType,)


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, _UNORDERABLE):
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


PLACE_BITS = 33               # of monotonically_increasing_id: the place inside a partition


READS_ONLY = {"Project", "Filter", "LogicalRelation", "SubqueryAlias", "View"}    # plan nodes


def _reads_files_only(df: DataFrame) -> bool:
    """Whether ``df`` is a deterministic projection or selection of stored files, whose rows come in file order."""
    if not df.inputFiles():
        return False
    left = [df._jdf.queryExecution().analyzed()]
    while left:
        node = left.pop()
        if node.nodeName().split(" ")[0] not in READS_ONLY or not node.deterministic():
            return False
        left += [node.children().apply(i) for i in range(node.children().size())]
    return True


def dense_key(df: DataFrame, order_by, name: str = "key", start: int | Column = 0, *,
              tie_break: list[str] | None = None, unique: bool = False, materialize: bool = True,
              run: str | None = None) -> DataFrame:
    """Add ``name`` = start + 1-based rank of each row in ascending tuple order.

    ``order_by`` holds column names or Column expressions (ascending, NULLs
    first, as Spark orders them). ``tie_break`` defaults to every other
    orderable column so equal prefixes still get a deterministic order.
    ``unique``: no two rows are equal in all these columns. ``materialize=False``
    keeps the input from being written first even if it isn't a reading of stored files
    (a caller whose rows come in the same order whenever a task is run again). ``run`` names
    a further column for ``key_in_runs``: rows with the same number lie next to each other in key order.
    """
    if isinstance(order_by, (str, Column)):
        order_by = [order_by]
    order = [_as_col(c) for c in order_by]
    if tie_break is None:
        named = {c for c in order_by if isinstance(c, str)}
        tie_break = [f.name for f in df.schema.fields
                     if f.name not in named and _orderable(f.dataType)]
    order += [F.col(c) for c in tie_break]
    columns = df.columns
    if not unique:
        if materialize and not _reads_files_only(df):
            df = _materialize(df, "dense-key-input")
        df = df.withColumn("__dkarrival", F.monotonically_increasing_id())
        order.append(F.col("__dkarrival"))
    placed = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .select(*columns, F.monotonically_increasing_id().alias("__dkpos")))
    stored = _materialize(placed, "dense-key-sorted")

    part = F.shiftright("__dkpos", PLACE_BITS)
    counts = sorted(stored.groupBy(part.alias("p")).count().collect())     # a row per partition
    offsets, running = [], 0
    for p, n in counts:
        offsets.append((p, running))
        running += n
    before = F.broadcast(df.sparkSession.createDataFrame(offsets, "__dkp long, __dkbefore long"))
    start_col = start if isinstance(start, Column) else F.lit(int(start))
    place = F.col("__dkpos").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    key = (start_col.cast("long") + F.col("__dkbefore") + place + 1).cast("long")
    keyed = stored.withColumn("__dkp", part).join(before, "__dkp").withColumn(name, key)
    if run is not None:
        keyed = keyed.withColumn(run, F.col("__dkp"))
    return keyed.drop("__dkp", "__dkbefore", "__dkpos")


def key_in_runs(df: DataFrame, order_by: list[str], name: str, run: str) -> DataFrame:
    """``name`` = 1-based rank in the order of ``order_by``, without an exchange.

    ``df`` must be made, row by row, from a table that ``dense_key`` numbered (``run`` is its column), without an
    exchange since, and ``order_by`` begin with that table's key. A task then reads pieces of
    files, each holding neighbouring keys, and no key's rows are read by two tasks. Each task
    sorts its rows and writes them with their place; per task and file one count and
    the smallest key tell how many rows come before.
    """
    placed = df.sortWithinPartitions(*order_by).withColumn("__dkpos", F.monotonically_increasing_id())
    stored = _materialize(placed, "key-in-runs")
    task = F.shiftright("__dkpos", PLACE_BITS)
    place = F.col("__dkpos").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    pieces = (stored.groupBy(task.alias("t"), F.col(run).alias("r"))
              .agg(F.min(order_by[0]).alias("first"), F.min(place).alias("at"), F.count(F.lit(1)).alias("n")).collect())
    before, running = [], 0
    for t, r, _, at, n in sorted(pieces, key=lambda x: x["first"]):      # one per task and file
        before.append((t, r, running - at))
        running += n
    before = F.broadcast(df.sparkSession.createDataFrame(before, "__dkt long, __dkr long, __dkbefore long"))
    return (stored.join(before, (task == before["__dkt"]) & (stored[run] == before["__dkr"]))
            .withColumn(name, F.col("__dkbefore") + place + 1).drop("__dkt", "__dkr", "__dkbefore", "__dkpos", run))
