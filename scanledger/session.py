"""Session for local runs, and the folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app_name: str = "scanledger") -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for tables that cut lineage or are read back.

    On a cluster it lies in the shared folder named by ``spark.checkpoint.dir``,
    so that it outlives lost executors, below a folder of the application.
    Only a local session may fall back to a folder of this machine. Tables stay
    until :func:`clear_scratch` removes them: a result that is not read to the
    end yet still needs them.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{run_folder(shared, spark.sparkContext.applicationId)}/{purpose}-{uuid.uuid4().hex}"
    if spark.conf.get("spark.master", "").startswith("local"):
        return tempfile.mkdtemp(prefix=f"run-{purpose}-", dir="/tmp")
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def run_folder(shared: str, application_id: str) -> str:
    """Where an application keeps its intermediate tables."""
    return f"{shared.rstrip('/')}/scanledger-{application_id}"


def clear_scratch(spark: SparkSession, application_id: str | None = None) -> bool:
    """Remove the intermediate tables of an application, by default of this one, once their results were read.

    Only the application's own folder below ``spark.checkpoint.dir`` is
    touched; false if there is none.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        return False
    name = application_id or spark.sparkContext.applicationId
    if not name or "/" in name or name in (".", ".."):
        raise ValueError("name an application")
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(run_folder(shared, name))
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(files.exists(folder) and files.delete(folder, True))
