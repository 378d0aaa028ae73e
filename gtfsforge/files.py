"""Files of the cluster's store, through the Hadoop API that Spark itself uses (any scheme Spark can read)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def at(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names in a folder that begin with the prefix, sorted; none if it doesn't exist."""
    p, fs = at(spark, path)
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p)) if n.startswith(prefix)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    p, fs = at(spark, path)
    fs.delete(p, True)


def make(spark: SparkSession, path: str) -> None:
    p, fs = at(spark, path)
    fs.mkdirs(p)


def touch(spark: SparkSession, path: str) -> None:
    p, fs = at(spark, path)
    fs.create(p, True).close()


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Puts a finished file in the place of another."""
    p, fs = at(spark, source)
    t, _ = at(spark, target)
    fs.delete(t, True)
    if not fs.rename(p, t):
        raise OSError(f"{source} can't be renamed to {target}")


def join(spark: SparkSession, parts: list[str], target: str, head: bytes) -> None:
    """Writes head and then the parts, in order, as one file.

    A store that can concatenate (HDFS) links the parts' blocks, and no byte is
    copied; on others the driver copies one buffer at a time and holds no rows.
    """
    jvm = spark.sparkContext._jvm
    t, fs = at(spark, target)
    out = fs.create(t, True)
    out.write(head)
    sources = [at(spark, x)[0] for x in parts]
    sources = [p for p in sources if fs.getFileStatus(p).getLen() > 0]
    if sources and fs.getScheme() == "hdfs":
        out.close()
        array = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(sources))
        for i, p in enumerate(sources):
            array[i] = p
        fs.concat(t, array)
        return
    for p in sources:
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(fs.open(p), out, 1 << 20, False)
    out.close()
