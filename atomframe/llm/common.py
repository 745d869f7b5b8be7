"""What the operators of this subpackage share: saved tables, and words and fingerprints as numpy arrays."""

from __future__ import annotations

import ctypes
import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from atomframe.session import shared_folder

#: Text bytes that one task handles at a time; a single longer text is handled alone.
CHUNK_BYTES = 8 << 20
#: The same where Python objects are made of every word.
WORD_CHUNK = 2 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where a local session names none."""
    return shared_folder(spark)


#: Bytes of a saved table that a writing task holds in memory.
ROW_GROUP = 16 << 20


#: Of how many partitions one file of a light table is made.
LIGHT = 8


def saved(df: DataFrame, name: str, light: bool = False) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again, which cuts its lineage. A light table has narrow
    rows, so that a file can hold several partitions."""
    spark = df.sparkSession
    df = df.coalesce(max(LIGHT, parts(spark) // LIGHT)) if light else df
    path = f"{shared_dir(spark)}/atomframe-{name}-{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes saved tables that nothing reads any more."""
    for df in tables:
        if files := df.inputFiles():
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: What a worker keeps from one task to the next, by the operator's name.
_HELD: dict[str, dict] = {}


def held(owner: str) -> dict:
    """What ``owner`` keeps in this worker; what others kept goes."""
    for name in [n for n in _HELD if n != owner]:
        del _HELD[name]
    return _HELD.setdefault(owner, {})


def give_back() -> None:
    """Returns freed memory to the system, so that a reused worker does not keep its largest task's."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


_LIBC = ctypes.CDLL(None)


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES, owner: str = "") -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of at most ``limit`` text bytes, or of one row. ``owner``: see ``held``."""
    held(owner)
    yield from _cut(batches, text, limit)
    give_back()


def _cut(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(text)
        sizes = np.cumsum(np.array(pc.binary_length(column).fill_null(0), dtype=np.int64))
        start = 0
        while start < batch.num_rows:
            base = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def raw(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A text column as UTF-8 bytes; null is empty."""
    column = batch.column(name).cast(pa.binary())
    return [x or b"" for x in column.to_pylist()]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(name)


class Numbering(dict):
    """Gives each new key the next number."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n

    def all(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), dtype=np.int64, count=len(keys))


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Word numbers of all texts one after another, the distinct words by number, and the words in each text."""
    ids = Numbering()
    numbers = np.fromiter(map(ids.__getitem__, itertools.chain.from_iterable(texts)), dtype=np.int64)
    return numbers, list(ids), np.array([len(words) for words in texts], dtype=np.int64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit fingerprint for each word, alike on every machine."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit fingerprint of every run of ``n`` neighbours."""
    out = np.zeros(max(0, len(hashes) - n + 1), dtype=np.uint64)
    for k in range(n):
        out = mixed(out * np.uint64(3) + hashes[k : k + len(out)] + MIX)
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1 ... of each range, one range after another."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
