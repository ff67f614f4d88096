"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Defaults a cluster job wants as well as a local test: AQE for runtime
# re-planning (partition coalescing, skew-join splitting, SMJ->BHJ when a
# side turns out small), UTC so timestamps agree with other engines.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(
    master: str | None = None,
    app_name: str = "gable",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return (or create) a session with the engine's defaults.

    ``master`` is only set when given, so ``spark-submit`` settings win on a
    cluster. ``shuffle_partitions`` should be sized so one shuffle partition
    holds ~128-256 MB at the target scale; locally it defaults to the cores.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(_DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if conf:
        settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, fitted tables and saved models.

    Reads ``spark.checkpoint.dir`` (the cluster names its shared folder
    there). Only when the session has none (local tests) a private folder is
    created and registered.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors "
                               "(a machine-local folder does not survive executor loss)")
        root = tempfile.mkdtemp(prefix="gable-ckpt-")
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique sub-path of the checkpoint root for a written table/model.

    The name carries the application id and a random part, so two
    applications that share the root (driver pids repeat in containers)
    never write to the same path.
    """
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/{name}-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    _own_paths.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables and models this driver process has written.

    Frames that still read them become invalid, so call it at the end of a
    run. Returns the number of paths removed; paths of other applications
    are never touched.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    removed = 0
    while _own_paths:
        path = jvm.org.apache.hadoop.fs.Path(_own_paths.pop())
        removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed


def cut_lineage(df: DataFrame, columnar: bool = False) -> DataFrame:
    """Cut the lineage of ``df`` in the shared checkpoint folder.

    Both forms survive executor loss (unlike a local checkpoint, the data is
    on the shared folder) and turn a long plan into a plain scan.

    * ``columnar=False``: reliable ``checkpoint()`` of the rows; keeps the
      partitioning. For matrices and small tables that are read whole.
    * ``columnar=True``: a Parquet table in the folder, read back. For wide
      frames that later passes scan a few columns at a time (fit
      statistics): each pass reads only its columns, compressed, and the
      planner gets file-size statistics.
    """
    if columnar:
        path = scratch_path(df.sparkSession, "cut")
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path)
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, fits: int = 1, rows_each: int = 5_000, held: int | None = None) -> DataFrame:
    """Deal the rows (``held`` of them) of a written or checkpointed table over enough partitions to keep all
    cores busy when ``fits`` jobs read it at once, each of ``rows_each`` rows or more.

    A written table often comes back as one file with one row group, which a fit reads with
    one core. Rows are dealt and sorted by their content, so the layout, on which MLlib's samples hang, is
    the same for the same rows. A table in enough files stays as it is. Cut the result again before it is read more than once.
    """
    held = df.count() if held is None else held
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = min(-(-cores // fits), -(-held // rows_each))
    if (len(df.inputFiles()) or df.rdd.getNumPartitions()) >= wanted:
        return df
    mixed = F.xxhash64(*df.columns)
    return df.repartition(wanted, mixed).sortWithinPartitions(mixed)


# scratch paths written by this process, for drop_scratch
_own_paths: list[str] = []
