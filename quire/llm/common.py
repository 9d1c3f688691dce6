"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.session import checkpoint_dir

# A word is a maximal run of anything but space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_words(data: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text; ``bytes.split`` cuts at exactly the six ASCII blanks."""
    return data.split() if data else []


def as_bytes(column) -> Iterator[bytes | None]:
    """The texts of an Arrow string column as UTF-8, one at a time."""
    import pyarrow as pa
    raw = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    return (x.as_py() for x in raw)


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """Lower the session's Arrow batch to ``rows`` texts; the default of 10,000 holds
    tens of MB per task outside the heap, however long the texts are."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(df.sparkSession.conf.get(name))
    if now <= 0 or now > rows:
        df.sparkSession.conf.set(name, rows)
    return df


def n_words(text: Column | str) -> Column:
    """Number of words of a text; null counts none."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """A fresh path in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"


def hash_sample(df: DataFrame, key: str, rows: int, order: list[str]) -> DataFrame:
    """At most ``rows`` rows of ``df``: those with the smallest hash of ``key``, ties by ``order``.

    A hash threshold from the row count leaves little more than ``rows`` rows
    before they are ordered, so tasks do not each send that many to the driver.
    """
    n = df.count()
    share = min(1.0, (rows + 10 * rows ** 0.5) / max(n, 1))
    draw = F.xxhash64(key)
    some = df if share == 1.0 else df.filter(draw < F.lit(-(1 << 63) + int(share * ((1 << 64) - 1))))
    return some.withColumn("__draw", draw).orderBy("__draw", *order).limit(rows).drop("__draw")


def with_position(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with its 1-based place in the global order by ``order`` (nulls first).

    The order is cut into ranges that tasks sort; only the number of rows per
    range is added up in one place.  Written to the shared folder in between.
    """
    keys = [F.col(c).asc_nulls_first() for c in order]
    nth = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # row in its partition
    ranged = cut(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                 .withColumn("__range", F.spark_partition_id()).withColumn("__nth", nth))
    before = Window.orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(F.col("__range").alias("__at")).count()
               .select("__at", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__offset")))
    return (ranged.join(offsets, F.col("__range") == F.col("__at"))
            .withColumn(name, F.col("__offset") + F.col("__nth") + 1).drop("__range", "__nth", "__at", "__offset"))
