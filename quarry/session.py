"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every quarry job relies on: AQE re-plans joins/partition counts from
# runtime statistics (so a small side becomes a broadcast only when its measured
# size allows it), skew-join splitting handles hot keys, and the UI stays off.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "quarry",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with quarry's defaults.

    ``master`` is only set when given; on a cluster the launcher decides it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only for local runs.

    On a cluster the folder must be the shared one named in ``spark.checkpoint.dir``;
    it is read from the session.  Only when it is unset *and* the master is local
    (tests, benches) is a fresh folder under the system temp directory used.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="quarry-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut_lineage(df):
    """Materialise ``df`` as a parquet table in the shared checkpoint folder and read it
    back: lineage is cut, the data survives executor loss, and the re-read table has
    true size statistics.  (``Dataset.checkpoint`` keeps the estimated statistics of
    the plan it replaces; in iterative jobs those estimates compound round after
    round until planning itself stalls.)  Never a local checkpoint."""
    spark = df.sparkSession
    path = f"{tables_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def tables_folder(spark: SparkSession) -> str:
    """Where this application writes its working tables: one folder of its own."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}"


def drop_tables(spark: SparkSession) -> None:
    """Delete this application's working tables, once no frame that reads them is needed."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(tables_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spread(df, partitions: int = 16, key: str = "id"):
    """A fixed number of partitions with a fixed row order, for MLlib fits that draw per
    partition: the fit then depends on the data and ``partitions`` only, not on the cluster
    or on how the input happened to be split."""
    return df.repartition(partitions, key).sortWithinPartitions(key)
