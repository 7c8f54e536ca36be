"""Session settings, the shared work folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(cores: str = "*", partitions: int = 16, app: str = "sitescore", **conf: str) -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors share one disk, may fall
    back to a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder
    if context.getCheckpointDir() is None:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="sitescore-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and go on from there.

    The shuffle files that led to the rows go once they are written; they would
    otherwise wait for the driver to collect garbage. Spark keeps the size that it
    guessed before the rows were made. If the files are larger, the guess is
    dropped: a table that is taken for a small one is broadcast through the
    driver's memory, however many rows it has.
    """
    shared_folder(df.sparkSession)
    # a plan of its own, so no other use of ``df`` looks for the files
    once = df.select("*")
    written = once.checkpoint(eager=True)
    cleaner = df.sparkSession.sparkContext._jsc.sc().cleaner()
    if cleaner.isDefined():
        for shuffle in _shuffles(once._jdf.queryExecution().executedPlan()):
            cleaner.get().doCleanupShuffle(shuffle, False)
    return _without_guess(written)


def _without_guess(written: DataFrame) -> DataFrame:
    """The written table, of unknown size if Spark takes it for smaller than its files are.

    Files of a small share of what may be broadcast are left alone: rows take several
    times as much as their files, which are compressed.
    """
    spark, plan = written.sparkSession, written._jdf.queryExecution().logical()
    folder = _checkpoint(written)
    size = _files(spark, folder).getContentSummary(folder).getLength() if folder is not None else 0
    if size <= max(plan.stats().sizeInBytes(), spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold() // 16):
        return written
    jvm = spark._jvm
    none = jvm.scala.Option.empty()
    rows = jvm.org.apache.spark.sql.execution.LogicalRDD(
        plan.output(), plan.rdd(), plan.outputPartitioning(), plan.outputOrdering(), plan.isStreaming(), plan.stream(), spark._jsparkSession, none, none
    )
    return DataFrame(jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, rows), spark)


def _checkpoint(written: DataFrame):
    """The folder that a table was written to."""
    file = written._jdf.queryExecution().logical().rdd().getCheckpointFile()
    return written.sparkSession._jvm.org.apache.hadoop.fs.Path(file.get()) if file.isDefined() else None


def _files(spark: SparkSession, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _shuffles(plan) -> set[int]:
    """Ids of the shuffles of a plan that has run."""
    found, todo = set(), [plan]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif kind == "ReusedExchangeExec":
            todo.append(node.child())
        else:
            if kind == "ShuffleExchangeExec":
                found.add(node.shuffleId())
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return found


def forget(written: DataFrame) -> None:
    """Remove the files of a table that :func:`cut_lineage` wrote; nothing may read it any more."""
    folder = _checkpoint(written)
    if folder is not None:
        _files(written.sparkSession, folder).delete(folder, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread rows over all tasks before a step that makes much of each row.

    Adaptive execution sizes tasks by the bytes they read, so it would put all
    rows of a small input into one task; a fixed number of partitions is kept.
    The hash makes this a partitioning of its own, so that it is not taken for
    one the rows already have.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, F.xxhash64(*keys))
