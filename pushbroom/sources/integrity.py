"""Checksums of files against their labels, and unpacking of archives."""

from __future__ import annotations

import hashlib
import re
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.workers import importable
from .files import opened, with_suffix


class ChecksumError(Exception):
    """A file is not what its label says."""


def md5(content: Column) -> Column:
    return F.md5(content)


def file_md5(spark: SparkSession, paths: DataFrame) -> DataFrame:
    """Adds md5 to ``paths`` (path), read in pieces by the executors."""
    importable(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_digest(p) for p in b.column(0).to_pylist()], pa.string())], ["path", "md5"])

    return paths.select("path").mapInArrow(run, "path string, md5 string")


def verify(files: DataFrame, labels: DataFrame, key: str = "path") -> DataFrame:
    """(key, md5, md5_checksum, ok) of files (key, md5) that have a label (key, md5_checksum)."""
    return files.join(labels, key).select(key, "md5", "md5_checksum", (F.lower("md5") == F.lower("md5_checksum")).alias("ok"))


def require(checked: DataFrame, key: str = "path") -> None:
    """ChecksumError naming a file that fails."""
    if bad := checked.where("NOT ok").orderBy(key).first():
        raise ChecksumError(f"{bad[key]}: md5 is {bad['md5']}, its label says {bad['md5_checksum']}")


def unpack(folder: str, basename: str, level: int = 1, check: bool = True) -> list[str]:
    """Extracts the first archive of a product (by path) beside it and returns the files.

    ``check`` tests the members' own checksums, and then each unpacked image against the checksum in the label beside it.
    """
    from ..functions.fixed import LEVEL_CODES

    found = next((p for p in sorted(Path(folder).rglob(f"*{LEVEL_CODES[level]}*.zip")) if basename in p.stem), None)
    if found is None:
        raise FileNotFoundError(f"no archive of {basename} below {folder}")
    with zipfile.ZipFile(found) as z:
        if check and (bad := z.testzip()):
            raise ChecksumError(f"{found}: {bad} is damaged")
        z.extractall(found.parent)
        out = [str(found.parent / n) for n in z.namelist()]
    for image in (p for p in out if check and p.endswith(".qub")):
        label(image)
    return out


def label(path: str) -> None:
    """ChecksumError if a file is not what the label beside it (the same name, ``.xml``) says; a label without a checksum says nothing."""
    with opened(with_suffix(path, ".xml")) as f:
        said = re.search(rb"<(?:\w+:)?md5_checksum>\s*(\w+)\s*<", f.read())
    if said and (got := _digest(path)) != said[1].decode().lower():
        raise ChecksumError(f"{path}: md5 is {got}, its label says {said[1].decode()}")


def _digest(path: str) -> str:
    """MD5 of a file read in pieces, so files of any size do."""
    h = hashlib.md5()
    with opened(path) as f:
        while piece := f.read(1 << 20):
            h.update(piece)
    return h.hexdigest()
