"""Session helpers: a configured SparkSession and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "zonecast",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this library assumes.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (about 128 MB per partition).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def reach(spark: SparkSession) -> None:
    """Puts this package's folder on the Python path of tasks, so that a local
    session finds it wherever the driver was started; a cluster gets the package
    with ``--py-files`` or on its machines."""
    env = spark.sparkContext.environment
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if top not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, top])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from the session (``spark.checkpoint.dir`` or a folder already set
    on the context).  Only a local-mode session (tests, a laptop) gets a
    folder of its own when none is set; a cluster without one is an error,
    because a machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        try:
            conf = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            conf = None
    if conf:
        sc.setCheckpointDir(conf)
        return conf
    if sc.master.startswith("local"):
        d = tempfile.mkdtemp(prefix="zonecast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(d)
        return d
    raise RuntimeError("spark.checkpoint.dir is not set: give the cluster a shared folder")


def materialize(df, name: str = "table", partition_by: tuple[str, ...] = ()):
    """Write ``df`` once as parquet under the cluster's checkpoint folder and
    read it back: a lineage cut that survives executor loss and costs one
    pass over the input (``DataFrame.checkpoint`` computes an unpersisted
    plan twice: once for the action, once for the checkpoint file). With
    ``partition_by`` the table has a folder for each value of these columns."""
    import uuid
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/zonecast-tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return spark.read.parquet(path)
