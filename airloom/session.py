"""Session settings and the shared folder used for written intermediates."""

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_dirs: dict[str, str] = {}  # one temporary folder per local application


def local_session(name: str = "airloom", cpus: str = "8", memory: str = "16g") -> SparkSession:
    """A local session for tests and the benchmark; a cluster job brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def join_in_place(spark: SparkSession) -> None:
    """Joins on (station, datetime) take rows that lie together by station as they are, on both sides. By default Spark
    deals both sides anew, unless they are dealt out by every column of the key."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Only where none is named (local runs) a temporary one is set."""
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="airloom-")
    return _local_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/airloom/{name}-{uuid.uuid4().hex}"
