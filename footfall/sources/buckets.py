"""Tables dealt into buckets by a key, so that grouping and joining by it moves no rows.

A table is a folder of Parquet files, one per bucket, and a small description beside it that
names the key, the number of buckets and the columns. The description is written last: a folder
without one is an unfinished write and is not read. Any session can open the folder; the table's entry
in the session's catalogue is made from the description.
"""

from __future__ import annotations

import json
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from footfall.session import remove_path

_DESCRIPTION = "key string, buckets int, columns string"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Store ``df`` at ``path`` in ``buckets`` files by hash of ``key``, each sorted by it.

    One shuffle at most: rows that already lie by ``key`` in as many partitions stay where they are.
    """
    spark = df.sparkSession
    remove_path(spark, f"{path}/about")
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", f"{path}/rows")
        .saveAsTable(_name(path))
    )
    about = spark.createDataFrame([(key, buckets, df.schema.json())], _DESCRIPTION)
    about.coalesce(1).write.mode("overwrite").parquet(f"{path}/about")


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``; Spark knows that its rows lie by the key."""
    name = _name(path)
    about = spark.read.schema(_DESCRIPTION).parquet(f"{path}/about").first()
    if not spark.catalog.tableExists(name):
        schema = T.StructType.fromJson(json.loads(about.columns))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{about.key}`) "
            f"SORTED BY (`{about.key}`) INTO {about.buckets} BUCKETS LOCATION '{path}/rows'"
        )
    return spark.table(name)


def is_complete(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/about/_SUCCESS")
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def forget(spark: SparkSession, path: str) -> None:
    """Delete a table's files and its entry in the catalogue."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    remove_path(spark, path)


def _name(path: str) -> str:
    """One name per path; two checksums, as the catalogue takes no slashes."""
    text = path.rstrip("/").encode()
    return f"bucketed_{zlib.crc32(text):08x}{zlib.adler32(text):08x}"
