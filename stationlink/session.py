"""Session helpers: one place for the settings the operators rely on."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings for a large cluster (hundreds of TB): many shuffle partitions that AQE
# coalesces to ~128 MB at run time and splits when skewed; scan splits of 256 MB;
# broadcasts only below 64 MB of estimated size.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[*]", app: str = "stationlink",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks. On a cluster use the cluster's session."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune_for_cluster(spark: SparkSession, overrides: dict | None = None) -> dict:
    """Apply ``CLUSTER_CONF`` (plus ``overrides``) to a running cluster session. A setting
    the cluster was launched with is kept. Returns what was set."""
    launched = spark.sparkContext.getConf()
    applied = {}
    for k, v in {**CLUSTER_CONF, **(overrides or {})}.items():
        if k in (overrides or {}) or not launched.contains(k):
            spark.conf.set(k, v)
            applied[k] = v
    return applied


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster (``spark.checkpoint.dir``).

    Only when it is unset on a local master (tests, bench) a private scratch folder is
    created and set; a cluster session without it is refused, since a folder local to
    the driver is not reachable from the executors and dies with the machine.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this job")
        d = tempfile.mkdtemp(prefix="stationlink-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for tables of one job below the checkpoint folder, deleted when the
    Python process ends."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def delete() -> None:
        try:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001 - the session may have ended; the folder is scratch
            pass

    atexit.register(delete)
    return root
