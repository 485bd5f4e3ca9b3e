"""Tables that cut lineage, kept in the folder that the cluster shares.

A job that loses an executor rereads these files, so nothing here uses a machine-local folder but on one
machine (a local master) whose session names none.
"""

from __future__ import annotations

import gc
import re
import tempfile
import time
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

TIDY_SECONDS = 4
_written: list[str] = []
_tidied = 0.0
_trims = True


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Where that is unset, a temporary one on a local master; ValueError on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def _path(spark: SparkSession, where: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def trim_native(spark: SparkSession) -> None:
    """Returns native memory that the driver's JVM has freed to the system.

    Plans of many exchanges run on hundreds of driver threads, and glibc keeps what each of them frees. Done by
    the JVM's own command, through MBeanServer's method since the server's class is not open to py4j. A JVM
    without it (before 17.0.9, or not on Linux) is left as it is.
    """
    global _trims
    if not _trims:
        return
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    try:
        texts, objects = jvm.java.lang.String, jvm.java.lang.Object
        kinds = ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")
        command = (jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap", gateway.new_array(objects, 0), gateway.new_array(texts, 0))
        types, args = gateway.new_array(jvm.java.lang.Class, len(kinds)), gateway.new_array(objects, len(kinds))
        for k, (kind, value) in enumerate(zip(kinds, command, strict=True)):
            types[k], args[k] = jvm.java.lang.Class.forName(kind), value
        invoke = jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethod("invoke", types)
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JError:
        _trims = False


def tidy(spark: SparkSession) -> None:
    """Lets the driver drop what finished jobs leave, at most every TIDY_SECONDS: Spark deletes shuffle files once nothing on the driver refers to them, which is seldom noticed within a job."""
    global _tidied
    if time.monotonic() - _tidied > TIDY_SECONDS:
        gc.collect()
        spark._jvm.System.gc()
        trim_native(spark)
        _tidied = time.monotonic()


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Writes df once as Parquet and returns the written table. What the writing shuffled is no longer needed then."""
    spark = df.sparkSession
    where = f"{shared_dir(spark)}/scratch-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(where)
    path, fs = _path(spark, where)
    fs.deleteOnExit(path)
    _written.append(where)
    tidy(spark)
    table = spark.read.schema(df.schema).parquet(where)
    table.scratch_path = where
    return table


def discard(table: DataFrame) -> None:
    """Deletes a table that scratch returned; call it only when nothing reads it any more."""
    path, fs = _path(table.sparkSession, table.scratch_path)
    fs.delete(path, True)
    _written.remove(table.scratch_path)


def mark() -> int:
    """A point to which ``release`` can go back."""
    return len(_written)


def release(spark: SparkSession, since: int = 0, spared: int = 0) -> None:
    """Deletes the tables written after ``since`` but for the last ``spared``; call it only when no result still reads them."""
    gone = _written[since : len(_written) - spared]
    del _written[since : since + len(gone)]
    for where in gone:
        path, fs = _path(spark, where)
        fs.delete(path, True)
