"""Session helpers: the shared folder and tables stored there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the folder named in ``spark.checkpoint.dir``.

    A folder of our own is taken only on a ``local`` master where none is set
    (tests); on a cluster an unset folder is an error, since a machine-local
    folder is lost with its executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="linkloom-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder; nothing is made there yet."""
    return f"{ensure_checkpoint_dir(spark)}/linkloom/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "table", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it from there.

    Cuts the lineage and survives the loss of executors, as the data lies in the
    shared folder. Later reads prune columns and push filters down, and the
    planner knows the table's size.
    """
    path = shared_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget_stored(spark: SparkSession) -> None:
    """Delete what ``stored`` and the jobs of this session have put into the shared folder.

    For the end of a job: results that were not written yet cannot be read any more.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/linkloom")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def row_count_within(df: DataFrame, bound: int) -> int | None:
    """Row count of ``df``, or None when it has more than ``bound`` rows."""
    n = df.limit(bound + 1).count()
    return n if n <= bound else None


# No scan above this size is dealt out anew.
SPREAD_BYTES = 256 << 20


def spread(scan: DataFrame) -> DataFrame:
    """Rows of a small scan of few files over all cores, for costly row-wise work.

    Files of one row group cannot be split by the reader. Larger scans are left as
    they are, so no more than ``SPREAD_BYTES`` are ever moved for this.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    size = scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if len(scan.inputFiles()) >= cores or int(str(size)) > SPREAD_BYTES:
        return scan
    return scan.repartition(cores)
