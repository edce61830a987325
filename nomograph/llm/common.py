"""Small helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import gc
import posixpath
from collections.abc import Callable
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nomograph.session import checkpoint_dir as checkpoint_dir, cut as cut, small_batches as small_batches  # for the operators

#: The bytes 0x09-0x0D and 0x20 separate words. bytes.split() without arguments splits on exactly these.
SPACE = " \t\n\x0b\x0c\r"
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder_in(spark: SparkSession, *parts: str) -> str:
    """A path in the shared folder."""
    return posixpath.join(checkpoint_dir(spark), *parts)


def _at(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    system, path = _at(spark, folder)
    return system.exists(path)


def remove(spark: SparkSession, folder: str) -> None:
    system, path = _at(spark, folder)
    system.delete(path, True)


Table = TypeVar("Table")
_kept: dict[str, object] = {}


def worker_table(name: str, make: Callable[[], Table]) -> Table:
    """A table that a worker process keeps between tasks. It keeps one, so that operators in turn don't add up."""
    if name not in _kept:
        no_table()
        _kept[name] = make()
    return _kept[name]  # type: ignore[return-value]


def no_table() -> None:
    """For operators without a table: lets go of another's, and gives its memory back to the system."""
    if not _kept:
        return
    _kept.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The column's strings as UTF-8 bytes, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def pick(df: DataFrame, *names: str) -> DataFrame:
    """df's own columns of these names; other columns, however named, stay out of the plan."""
    return df.select(*[df[f"`{n}`"] for n in names])


def hash_share(*of: Column | str) -> Column:
    """A number from 0 to 1 by a hash of the columns, as fine as a double: rows below a share make a sample of that share."""
    return F.xxhash64(*of).cast("double") / 2.0**64 + 0.5
