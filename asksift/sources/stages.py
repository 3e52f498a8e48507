"""Stage tables: written once, read from there on."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")
    return df


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    leave it unset and gets a temporary folder; elsewhere executors would each
    write to their own disk, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        base = tempfile.mkdtemp()
    return f"{base.rstrip('/')}/asksift-{uuid.uuid4().hex}"


def drop_stages(spark: SparkSession, *folders: str) -> None:
    """Delete stage tables, or all below a folder, that are no longer needed."""
    jvm = spark.sparkContext._jvm
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Stage tables are written once and read a few times: Zstandard takes a quarter off
#: Snappy's bytes.
CODEC = "zstd"


#: Spark's setting that a query's shuffle files go when it ends. Without it they lie on
#: disk until the driver's garbage is collected: a job of many stages would hold them all.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """For writes: what a finished write has shuffled is deleted. Nothing reads it again,
    as one goes on from the written table."""
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    with shuffles_dropped(df.sparkSession):
        df.write.mode(mode).option("compression", CODEC).parquet(path)


def read_table(spark: SparkSession, path: str, *required: str) -> DataFrame:
    """Read a stage table back."""
    return require_columns(spark.read.parquet(path), *required)


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write a stage table and go on from it, so that nothing before it, model
    calls above all, runs again; a lost executor costs a read, not a rerun. The
    schema is known, so reading it back takes no job."""
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_parts(parts: list[DataFrame], path: str) -> DataFrame:
    """A stage table out of parts that are written one after the other, so that no more
    than one of them has its shuffles on disk."""
    for number, part in enumerate(parts):
        write_table(part, path, "append" if number else "overwrite")
    return parts[0].sparkSession.read.schema(parts[0].schema).parquet(path)


def counted_stage(
    df: DataFrame, path: str, kept: Callable[[DataFrame], DataFrame] | None = None, **metrics: Column
) -> tuple[DataFrame, dict]:
    """The same, with aggregates of the rows taken while they are written, so
    that no second scan is needed for them. ``kept`` says what of the counted rows is
    written, all if it is not given."""
    seen = Observation()
    observed = df.observe(seen, *[column.alias(name) for name, column in metrics.items()])
    df = kept(observed) if kept else observed
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get


def bucketed_stage(df: DataFrame, path: str, key: str, buckets: int, *order: str) -> DataFrame:
    """A stage table dealt into buckets by ``key`` and sorted by it and ``order``, one
    file per bucket. Grouping, ranking or joining such tables by their key, with the
    same number of buckets, takes no shuffle."""
    dealt = df.repartition(buckets, key).sortWithinPartitions(key, *order)
    name = _table_name(path)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    writer = dealt.write.mode("overwrite").option("compression", CODEC).bucketBy(buckets, key).sortBy(key, *order)
    with shuffles_dropped(df.sparkSession):
        writer.option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, path: str, key: str, buckets: int, *order: str) -> DataFrame:
    """The same table in a session that does not know it yet."""
    name = _table_name(path)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    by = ", ".join(f"`{c}`" for c in (key, *order))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def _table_name(path: str) -> str:
    """A name in the session's catalog, by the path."""
    return f"asksift_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
