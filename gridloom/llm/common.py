"""What the text operators share: picking columns, cutting lineage, streaming."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import threading
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word definitions: space and the ASCII controls 9 to 13.
SPACE = r"\x20\x09-\x0D"
#: Rows of a key that a join's task may get, whatever the number of rows.
HOT = 10_000
#: The same word pattern for Spark and for Python.
WORD = rf"[^{SPACE}]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def place(df: DataFrame, name: str) -> int:
    """Where a column is; an exact name wins over one that differs in case, and the first of several wins."""
    at = [i for i, c in enumerate(df.columns) if c == name]
    at = at or [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if not at:
        raise ValueError(f"column {name!r} is missing")
    return at[0]


def by_place(df: DataFrame) -> DataFrame:
    """The same rows with columns __0, __1 ..., which no other name clashes with."""
    return df.toDF(*[f"__{i}" for i in range(len(df.columns))])


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Select columns under new names, by position.

    Every other column is left out, so clashing extra columns never make a
    reference ambiguous.
    """
    return by_place(df).select(*[F.col(f"__{place(df, old)}").alias(new) for new, old in columns.items()])


def beside(df: DataFrame, **columns: str) -> DataFrame:
    """All columns by place, and the named ones once more under new names."""
    return by_place(df).select("*", *[F.col(f"__{place(df, old)}").alias(new) for new, old in columns.items()])


def restored(rows: DataFrame, like: DataFrame, **changed: str) -> DataFrame:
    """From rows of ``beside``: the columns of ``like`` under its names; ``changed`` ones come from other columns."""
    at = {place(like, old): new for old, new in changed.items() if any(c.lower() == old.lower() for c in like.columns)}
    kinds = [f.dataType for f in like.schema]
    columns = [F.col(at[i]).cast(kinds[i]) if i in at else F.col(f"__{i}") for i in range(len(kinds))]
    return rows.select(*[c.alias(f"__{i}") for i, c in enumerate(columns)]).toDF(*like.columns)


_IN_USE: list[tuple[str, Callable[[], object]]] = []


def hold(kind: str, release: Callable[[], object] = lambda: None) -> None:
    """Say at the start of a task what this worker keeps between tasks, and how it is let go.

    Workers are reused by later stages.  The first task of another kind lets go
    of what the last kind kept, and gives the memory back to the system.
    """
    if _IN_USE and _IN_USE[0][0] == kind:
        return
    while _IN_USE:
        _IN_USE.pop()[1]()
    _IN_USE.append((kind, release))
    give_back()


def give_back() -> None:
    """Give this process's unused memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once for all its uses in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder; the session names it, and only a local session may go without."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="gridloom-")
        sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage, in the folder that executors share."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def settle_round(df: DataFrame, rows: int | None = None, each: int = 200_000, costly: bool = False) -> DataFrame:
    """``settle`` for the rounds of a loop: without the estimated size.

    A checkpoint hands on the size that the optimizer expected, and a join's is
    the product of its inputs'.  Over a loop's rounds that number would get
    millions of digits and fill the driver.

    With ``rows``, which the result has at most, it is written in files of about
    ``each`` rows, so that what is small in a loop isn't spread over as many
    files, and later shuffles over as many more, as the whole input.  ``costly``
    rows are made by as many tasks as before and dealt out to those files.
    """
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    if rows is not None:
        files = max(1, -(-rows // each))
        df = df.repartition(files) if costly else df.coalesce(files)
    settled = settle(df)._jdf
    spark = df.sparkSession
    rows = settled.queryExecution().toRdd()
    return Classic(spark._jsparkSession.internalCreateDataFrame(rows, settled.schema(), False), spark)


def look_up(rows: DataFrame, found: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows.join(found, keys)`` for keys that may stand for a large share of the rows.

    ``found`` has one row a key, with the number n of the rows that have it (the
    result has no n); ``total`` is the sum of n.  The hot keys, of which there
    are 10,000 at most whatever the total, are joined by a broadcast, so that no
    task gets all rows of one; the others, by a shuffle, have few rows each.
    """
    limit = max(HOT, total // 10_000)
    hot = found.where(F.col("n") > limit).drop("n") if total > limit else None
    if hot is None or not hot.head(1):
        return rows.join(found.drop("n"), keys)
    near = F.broadcast(hot)
    cold = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(found.where(F.col("n") <= limit).drop("n"), keys)
    return cold.unionByName(rows.join(near, keys))


_LIMIT = threading.Lock()  # of free heap, while it is lowered


def tidy(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of rounds that are over, and give the driver's unused memory back.

    It deletes them when the driver's JVM finds them unreachable, which on a
    large heap can be long after a loop has filled the disks.  After a
    collection the heap otherwise stays at up to 3.3 times what is in use, and
    what the C library has freed stays with the process.  The limit for free
    heap is lowered for this collection only.
    """
    give_back()
    jvm = spark.sparkContext._jvm
    management = jvm.java.lang.management.ManagementFactory
    options = most = None
    with _LIMIT:
        with contextlib.suppress(Py4JError):  # only HotSpot has them
            options = management.getPlatformMXBean(jvm.java.lang.Class.forName("com.sun.management.HotSpotDiagnosticMXBean"))
            most = options.getVMOption("MaxHeapFreeRatio").getValue()
            options.setVMOption("MaxHeapFreeRatio", options.getVMOption("MinHeapFreeRatio").getValue())
        try:
            jvm.System.gc()
        finally:
            if most is not None:
                options.setVMOption("MaxHeapFreeRatio", most)
    with contextlib.suppress(Py4JError):  # older JVMs don't have it
        array, named = spark.sparkContext._gateway.new_array, jvm.java.lang.Class.forName
        kinds, request = array(jvm.java.lang.Class, 4), array(jvm.java.lang.Object, 4)
        for i, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[i] = named(kind)
        request[0], request[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        request[2], request[3] = array(jvm.java.lang.Object, 0), array(jvm.java.lang.String, 0)
        # The server's class isn't public, its interface is.
        named("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(management.getPlatformMBeanServer(), request)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one text column holds about ``limit`` bytes.

    A single longer text is a slice of its own: texts are never split.
    """
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        start = size = 0
        for i, s in enumerate(sizes):
            if i > start and size + s > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += s
        yield batch.slice(start, n - start)


def table(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )
