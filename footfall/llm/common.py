"""Helpers shared by the text operators."""

from __future__ import annotations

import pickle
import sys
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import chain, count
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Text bytes handled at once inside a task; a longer text is handled alone.
CHUNK_BYTES = 4 << 20

#: Fixed values of the task's contracts: ASCII white space ends a word.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table of ``folder``, in at least as many partitions as the session has cores."""
    found = spark.read.parquet(f"{folder}/{table}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return found if found.rdd.getNumPartitions() >= cores else found.repartition(cores)


def texts_of(column: pa.Array) -> list[str]:
    """Texts of an Arrow column, null as empty."""
    return [t if t is not None else "" for t in column.to_pylist()]


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a piece holds at most ``limit`` text bytes, or one row."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def map_texts(
    df: DataFrame,
    columns: list[Column],
    function: Callable[[list[str], pa.RecordBatch], dict[str, object] | None],
    schema: str,
    limit: int = CHUNK_BYTES,
) -> DataFrame:
    """Apply ``function(texts, rows)`` to pieces of ``columns``, whose first one is the text.

    ``function`` returns one list or array per name of ``schema``.
    """
    source = df.select(columns[0].cast("string").alias("text"), *columns[1:])
    types = StructType.fromDDL(schema)
    arrow = to_arrow_schema(types)

    def run(batches):
        for rows in pieces(batches, "text", limit):
            found = function(texts_of(rows.column(0)), rows)
            if found is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[f.name], type=f.type, from_pandas=True) for f in arrow], schema=arrow
                )

    return source.mapInArrow(run, types)


def filter_texts(docs: DataFrame, text: str, function: Callable[[list[str]], object]) -> DataFrame:
    """Rows of ``docs``, with all their columns, for which ``function(texts)`` gives true."""

    def run(batches):
        for rows in pieces(batches, text):
            keep = np.asarray(function(texts_of(rows.column(rows.schema.get_field_index(text)))), dtype=bool)
            if keep.any():
                yield rows.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def crc_fold(key: Column, folds: int = 5) -> Column:
    """``crc32`` of the key written as text, modulo ``folds``; a null key counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def hash_share(rows: DataFrame, key: Column, n: int, total: int) -> DataFrame:
    """About ``n`` of ``total`` rows, chosen by hash of ``key`` (all, if there are no more).

    The number is ``n`` give or take a few of its square roots; no task or driver gets more.
    """
    return rows if total <= n else rows.where(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < int(n / total * (1 << 40)))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_of_ids(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def numbered(lists: list[list]) -> tuple[np.ndarray, np.ndarray, list]:
    """Numbers of all entries in order of first sight, the lists' sizes, and the different entries."""
    sizes = np.array([len(own) for own in lists], dtype=np.int64)
    seen: defaultdict = defaultdict(count().__next__)
    codes = np.fromiter(map(seen.__getitem__, chain.from_iterable(lists)), np.int64, int(sizes.sum()))
    return codes, sizes, list(seen)


def ragged(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``starts``, one after another."""
    ends = segments(counts)
    return flat[np.repeat(starts - ends[:-1], counts) + np.arange(ends[-1])]


class Shared:
    """A value of bounded size for all tasks.

    Plain broadcasts name the classes of their values, which only a worker with this package could
    load. The bytes sent here carry the classes along. A task unpacks them once.
    """

    def __init__(self, spark: SparkSession, value: object):
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @cached_property
    def value(self):
        return pickle.loads(self._sent.value)


def per_process(key, make: Callable[[], object]):
    """An object that a Python worker keeps from task to task.

    Functions travel by value, so their own globals last for one task only.
    """
    kept = sys.modules.setdefault("_footfall_kept", ModuleType("_footfall_kept")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def segments(lengths: np.ndarray) -> np.ndarray:
    """Offsets 0, l0, l0 + l1, … of consecutive segments."""
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out
