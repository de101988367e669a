"""Durable cuts of lineage, and row numbers that need no single task."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where that is unset (tests) a new local one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        found = tempfile.mkdtemp(prefix="rosterlake-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def spread(df: DataFrame) -> DataFrame:
    """df over all cores, if its files give fewer partitions than there are cores (one small file); else as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df below the shared folder and reads it back: a cut of lineage that survives the loss of any executor. The shuffle files
    of the write go with it; else they would stay on the executors' disks until the driver happens to collect its garbage."""
    path, conf = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}", df.sparkSession.conf
    given = conf.get(_SHUFFLE_CLEANUP, None)
    conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if given is None:
            conf.unset(_SHUFFLE_CLEANUP)
        else:
            conf.set(_SHUFFLE_CLEANUP, given)
    _return_memory(df.sparkSession)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    if _OPEN:
        _OPEN[-1].written.append((found, path))
    return found


def _return_memory(spark: SparkSession) -> None:
    """Lets the driver's JVM give freed native memory (of its compiler, of results) back to the system, if it has a command for that.
    Long plans run hundreds of jobs, between which such memory would add up."""
    jvm, key = spark._jvm, spark.sparkContext.applicationId
    if key not in _TRIM:
        methods = jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods()
        _TRIM[key] = next(m for m in methods if m.getName() == "invoke")
    if _TRIM[key] is not None:
        arguments = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)
        arguments[0] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        arguments[1] = "systemTrimNativeHeap"
        try:
            _TRIM[key].invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), arguments)
        except Py4JJavaError:  # another JVM
            _TRIM[key] = None


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_TRIM: dict[str, object] = {}
_OPEN: list[Scratch] = []


class Scratch:
    """`with Scratch() as s:` deletes at its end what materialize() has written inside, but for the frames given to s.keep(): those
    belong to the scope around it, if there is one, and else stay. What is made from deleted frames must be written before."""

    def __init__(self) -> None:
        self.written: list[tuple[DataFrame, str]] = []
        self.kept: list[DataFrame] = []

    def keep(self, df: DataFrame) -> DataFrame:
        self.kept.append(df)
        return df

    def __enter__(self) -> Scratch:
        _OPEN.append(self)
        return self

    def __exit__(self, *failed: object) -> None:
        _OPEN.remove(self)
        for df, path in self.written:
            if any(df is x for x in self.kept):
                if _OPEN:
                    _OPEN[-1].written.append((df, path))
            else:
                spark = df.sparkSession
                place = spark._jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def number_rows(df: DataFrame, order: list[Column], name: str = "id") -> DataFrame:
    """df with a column 1..n in the given order. Rows are range-sorted and written with their place in their partition; then the
    sizes of the partitions, one row each, are summed up."""
    marked = materialize(df.orderBy(*order).withColumn("__place", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__place", 33)
    sizes = marked.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    joined = marked.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    number = F.col("__before") + F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return joined.select(number.alias(name), *df.columns)


def number_within(df: DataFrame, key: str, order: list[Column], name: str = "id") -> DataFrame:
    """df with a column 1..n in the given order within each key (null is a key of its own). As number_rows: a key with very many
    rows stays spread over the partitions of the sort."""
    marked = df.withColumn("__key", F.struct(F.col(key).isNull().alias("none"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key")))
    marked = materialize(marked.orderBy("__key", *order).withColumn("__place", F.monotonically_increasing_id()), "numbered")
    marked = marked.withColumn("__part", F.shiftright("__place", 33))
    runs = marked.groupBy("__key", "__part").agg(F.min("__place").alias("__first"), F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("__before", F.coalesce(before, F.lit(0)))
    number = F.col("__before") + F.col("__place") - F.col("__first") + 1
    return marked.join(runs, ["__key", "__part"]).select(*df.columns, number.alias(name))
