"""Files by path or URI: local and mounted ones directly, those of other stores by the file systems that can open them."""

from __future__ import annotations

from typing import BinaryIO
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession


def local(path: str) -> str | None:
    """The local path of ``path``, or None if it is in another store."""
    at = urlparse(path)
    return unquote(at.path) if at.scheme == "file" else path if at.scheme == "" else None


def opened(path: str) -> BinaryIO:
    """A file object of random access, on the driver or an executor."""
    if (at := local(path)) is not None:
        return open(at, "rb")  # noqa: SIM115
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def listing(spark: SparkSession, folder: str) -> list[str]:
    """Every file below ``folder`` in any store that Spark reads, in order; contents are not read."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(at, True)
    out = []
    while found.hasNext():
        path = found.next().getPath().toString()
        out.append(local(path) or path)
    return sorted(out)


def with_suffix(path: str, suffix: str) -> str:
    """``path`` with its last suffix replaced."""
    head, slash, name = path.rpartition("/")
    return head + slash + name.rpartition(".")[0] + suffix if "." in name else path + suffix
