"""Reading inputs and writing results."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitescore.session import cut_lineage


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan of one parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def select_sites(
    df: DataFrame,
    columns: Sequence[str],
    name_like: str | None = None,
    not_null: Sequence[str] = ("site_id",),
    constants: dict[str, object] | None = None,
    name_column: str = "name",
) -> DataFrame:
    """Project sites, keep those whose name matches and whose keys are known."""
    for column in not_null:
        df = df.where(F.col(column).isNotNull())
    if name_like is not None:
        df = df.where(F.col(name_column).like(name_like))
    extra = [F.lit(value).alias(name) for name, value in (constants or {}).items()]
    return df.select(*columns, *extra)


def read_listings_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Uploaded candidate list; the schema is declared, so no inference pass."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def write_listings_csv(df: DataFrame, path: str) -> None:
    """Write with quotes around blanks so that leading and trailing ones survive."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_table(
    df: DataFrame,
    name: str,
    path: str | None = None,
    mode: str = "overwrite",
    fmt: str = "parquet",
    bucket_by: tuple[int, str] | None = None,
) -> DataFrame:
    """Create (or drop and recreate) a catalogue table and return it.

    ``bucket_by`` (number, column) stores the rows hashed and sorted by a join
    key, so that later joins on that key read the table without a shuffle.
    """
    writer = df.write.format(fmt).mode(mode)
    if path is not None:
        writer = writer.option("path", path)
    if bucket_by is not None:
        number, column = bucket_by
        writer = writer.bucketBy(number, column).sortBy(column)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def append_evolving(df: DataFrame, path: str) -> bool:
    """Create or append a parquet dataset; new columns are allowed, empty input is skipped.

    Returns whether something was written.
    """
    if df.isEmpty():
        return False
    df.write.mode("append").parquet(path)
    return True


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read a dataset whose files may have different columns."""
    return spark.read.option("mergeSchema", True).parquet(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` under ``name`` for SQL text and return it."""
    df.createOrReplaceTempView(name)
    return df


def _finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was committed (a cut-off one leaves no marker)."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


#: Folder of the rows without a batch id, which readers take as NULL.
NO_BATCH = "__HIVE_DEFAULT_PARTITION__"


def run_in_batches(
    df: DataFrame,
    steps: dict[str, Callable[[DataFrame], DataFrame]],
    folder: str,
    batch_column: str = "batch_id",
    parallelism: int = 4,
) -> dict[str, str]:
    """Process ``df`` batch by batch and keep every step's result on disk.

    The steps of a batch run in order, each on the written output of the one
    before; up to ``parallelism`` batches run at a time. A batch directory that
    is already complete is not computed again, so a stopped run goes on where it
    ended; one that was cut off is overwritten. The batch ids come from the
    data; there are as many jobs as ids, so choose coarse ones.
    """
    spark = df.sparkSession

    def run(batch: object) -> None:
        current = df.where(F.col(batch_column).eqNullSafe(F.lit(batch))).drop(batch_column)
        for name, step in steps.items():
            target = f"{folder}/{name}/{batch_column}={NO_BATCH if batch is None else batch}"
            if not _finished(spark, target):
                step(current).write.mode("overwrite").parquet(target)
            current = spark.read.parquet(target)

    ids = [row[0] for row in df.select(batch_column).distinct().orderBy(batch_column).toLocalIterator()]
    with ThreadPool(parallelism) as pool:
        pool.map(inheritable_thread_target(spark)(run), ids)
    return {name: f"{folder}/{name}" for name in steps}


def _without(df: DataFrame, other: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is not in ``other``; NULL equals NULL."""
    return df.alias("l").join(other.alias("r"), F.col(f"l.{column}").eqNullSafe(F.col(f"r.{column}")), "left_anti")


def run_open_batches(
    df: DataFrame,
    steps: dict[str, Callable[[DataFrame], DataFrame]],
    folder: str,
    batch_column: str = "batch_id",
) -> dict[str, str]:
    """Process all batches that are not finished, in one job for each step whatever their number.

    A step gets rows with their ``batch_column`` and returns it with its result,
    which is written by batch; the next step reads what was written. Only after
    a write was committed are its batches noted as finished, also those without
    a result. A run that stops between goes on with the batches that were not
    noted; their folders are written anew and the others are left alone. Rows
    without a batch are the batch NULL. A batch is finished by its id: rows that
    join it later are not seen.
    """
    spark = df.sparkSession
    source, written = df, {}
    for name, step in steps.items():
        target, notes = f"{folder}/{name}", f"{folder}/_finished/{name}"
        batches = source.select(batch_column).distinct()
        if _finished(spark, notes):
            batches = _without(batches, spark.read.schema(batches.schema).parquet(notes), batch_column)
        todo = cut_lineage(batches)
        match = F.col(f"l.{batch_column}").eqNullSafe(F.col(f"r.{batch_column}"))
        result = step(source.alias("l").join(todo.alias("r"), match, "left_semi"))
        if not todo.isEmpty():
            result.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(batch_column).parquet(target)
            todo.write.mode("append").parquet(notes)
        elif not _finished(spark, target):
            result.limit(0).write.mode("append").partitionBy(batch_column).parquet(target)
        # a result without rows leaves no file to read a schema from
        source = spark.read.schema(result.schema).parquet(target)
        written[name] = target
    return written


def with_batch(df: DataFrame, batches: DataFrame, key: str = "site_id", batch_column: str = "batch_id") -> DataFrame:
    """Attach the batch id of every key; keys without a batch stay."""
    return df.join(batches.select(key, batch_column).distinct(), on=key, how="left")


def limit_batches(df: DataFrame, n: int, batch_column: str = "batch_id") -> DataFrame:
    """Rows of the first n batches, in the order of the batch ids."""
    first = df.select(batch_column).distinct().orderBy(batch_column).limit(n)
    return df.join(first, on=batch_column, how="left_semi")
