"""Runtime plumbing: ship the package to Python workers, broadcast small values."""

from __future__ import annotations

import hashlib
import io
import os
import zipfile

from pyspark.sql import SparkSession

_PKG_DIR = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _package_zip() -> bytes:
    buf = io.BytesIO()
    root = os.path.dirname(_PKG_DIR)
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(_PKG_DIR):
            if "__pycache__" in d:
                continue
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    return buf.getvalue()


def ensure_package(spark: SparkSession) -> None:
    """Make ``chatloom`` importable in Python workers (once per SparkContext).

    Kernels referenced by ``mapInArrow`` are pickled by module reference, so the
    package must reach executors: it is zipped in memory, written to the shared
    checkpoint folder through the Hadoop FileSystem API and added as a py-file.
    """
    from chatloom.session import checkpoint_dir
    sc = spark.sparkContext
    if getattr(sc, "_chatloom_shipped", False):
        return
    data = _package_zip()
    jvm = sc._jvm
    path = f"{checkpoint_dir(spark).rstrip('/')}/chatloom-pkg-{hashlib.sha1(data).hexdigest()[:12]}.zip"
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(p):
        out = fs.create(p, True)
        out.write(bytearray(data))
        out.close()
    sc.addPyFile(path)
    sc._chatloom_shipped = True


def broadcast_value(spark: SparkSession, value):
    return spark.sparkContext.broadcast(value)
