"""Small Hadoop-FileSystem helpers (work on any Hadoop-supported store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def rename_suffix(spark: SparkSession, root: str, old: str, new: str) -> int:
    """Rename every ``*old`` file below ``root`` to ``*new`` (e.g. Spark's ``.txt`` parts to ``.jsonl``)."""
    jvm = spark.sparkContext._jvm
    p, fs = _fs(spark, root)
    it = fs.listFiles(p, True)
    n = 0
    while it.hasNext():
        st = it.next()
        src = st.getPath()
        name = src.getName()
        if name.endswith(old):
            fs.rename(src, jvm.org.apache.hadoop.fs.Path(src.getParent(), name[: -len(old)] + new))
            n += 1
    return n


def list_parts(spark: SparkSession, root: str) -> list[str]:
    """Paths of the data files below ``root``, relative to it and in order."""
    p, fs = _fs(spark, root)
    base = fs.makeQualified(p).toString().rstrip("/") + "/"
    it, out = fs.listFiles(p, True), []
    while it.hasNext():
        path = it.next().getPath().toString()
        if not path.rsplit("/", 1)[-1].startswith(("_", ".")):
            out.append(path.removeprefix(base))
    return sorted(out)


def move(spark: SparkSession, src: str, dst: str) -> None:
    """Rename a file; a file of that name gives way."""
    p, fs = _fs(spark, src)
    to = _fs(spark, dst)[0]
    if fs.exists(to):
        fs.delete(to, False)
    if not fs.rename(p, to):
        raise OSError(f"cannot rename {src} to {dst}")


def remove_tree(spark: SparkSession, path: str) -> None:
    """Delete a derived table or file tree of our own."""
    p, fs = _fs(spark, path)
    fs.delete(p, True)
