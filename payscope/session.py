"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN_FOLDER: list[str] = []


def local_session(cores: str | int = "*", app: str = "payscope") -> SparkSession:
    """A session for tests and the benchmark. A cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in
    ``spark.checkpoint.dir``. Only a local master may fall back to a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if not _OWN_FOLDER:
        _OWN_FOLDER.append(tempfile.mkdtemp(prefix="payscope-"))
        atexit.register(shutil.rmtree, _OWN_FOLDER[0], ignore_errors=True)
    return _OWN_FOLDER[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, removed when the application ends (a
    remote client, which has no file system at hand, leaves that to the cluster)."""
    own = f"{shared_folder(spark)}/payscope-{uuid.uuid4().hex}"
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        folder = jvm.org.apache.hadoop.fs.Path(own)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)
    return f"{own}/{name}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write once, read back: the plan of ``df`` runs one time however many passes
    follow, the result survives lost executors, and later reads prune columns and
    push filters, which a cached or checkpointed RDD would not."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
