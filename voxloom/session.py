"""Session defaults and the two places where an operator touches shared storage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: dict[str, SparkSession] = {}  # folders of tables that this process wrote and has not removed


def build_session(master: str = "local[*]", name: str = "voxloom", **conf: str) -> SparkSession:
    """A session with the defaults the operators are planned for.

    AQE coalesces and splits shuffle partitions at run time, so the initial number may be
    generous; time is UTC everywhere; ANSI mode stays on (Spark 4's default).
    """
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    builder = SparkSession.builder.master(master).appName(name)
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` where it is set.

    Only where the setting is missing and the master is local (tests, a laptop) a temporary folder is made and
    remembered in the session under ``voxloom.shared.dir``; on a cluster a missing setting is an error, since a folder of one
    machine would lose rows.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    own = spark.conf.get("voxloom.shared.dir", None)
    if not own:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        own = "file://" + tempfile.mkdtemp(prefix="voxloom-")
        spark.conf.set("voxloom.shared.dir", own)
    return own


def table_folder(spark: SparkSession, stage: str) -> str:
    """A fresh path for one written intermediate table, removed by :func:`release_tables` at the latest."""
    path = f"{shared_folder(spark)}/voxloom/{stage}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(release_tables)
    _WRITTEN[path] = spark
    return path


def cut_lineage(df: DataFrame, stage: str) -> DataFrame:
    """Write ``df`` as a table into the shared folder and read it again.

    Later stages then restart from files that outlive any executor, and the optimizer sees
    true sizes. Rows, order-insensitively, and the schema are unchanged.
    """
    path = table_folder(df.sparkSession, stage)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(df_path_owner: DataFrame) -> None:
    """Remove the files of a table made by :func:`cut_lineage` that nothing reads any more."""
    for name in {f.rpartition("/")[0] for f in df_path_owner.inputFiles()}:
        if "/voxloom/" in name:
            _remove(df_path_owner.sparkSession, name)
            _WRITTEN.pop(name, None)


def release_tables() -> None:
    """Remove all tables that are still there, when no result that reads them is used any more.

    It runs by itself when the driver's process ends.
    """
    for path, spark in list(_WRITTEN.items()):
        try:
            _remove(spark, path)
        except Exception:  # the session is gone, or was never this one's to clean up
            pass
        _WRITTEN.pop(path, None)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
