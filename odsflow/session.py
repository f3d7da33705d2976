"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


SHUFFLE = "spark.sql.shuffle.partitions"
PARTITIONS_PER_CORE = 3
BYTES_PER_PARTITION = 128 << 20
ASIDE = "__old_"


def build_session(
    app: str, master: str | None = None, conf: dict[str, str] | None = None, input_bytes: int | None = None
) -> SparkSession:
    """A session with the settings the jobs expect; `conf` adds or replaces settings.

    Unless `conf` names a number, shuffles start with three partitions per core that is there at the
    start, or with one per BYTES_PER_PARTITION of `input_bytes` if that is more (executors may still
    come, and AQE merges small partitions but does not cut ordinary ones).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if SHUFFLE not in settings:
        by_size = -(-(input_bytes or 0) // BYTES_PER_PARTITION)
        spark.conf.set(SHUFFLE, str(max(PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism, by_size)))
    return spark


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path and the path object (works for any store)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; an absent folder has none."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return []
    return [status.getPath().getName() for status in fs.listStatus(target)]


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def replace_folder(spark: SparkSession, fresh: str, path: str) -> None:
    """Puts a written folder in the place of another one.

    The old folder is moved aside, deleted only once the new one is in place, and moved back if that fails; the new
    rows then stay where they were written. What a crash between the two moves leaves is put right by `restore_folder`.
    """
    fs, source = file_system(spark, fresh)
    target, aside = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path.rstrip('/')}{ASIDE}{uuid.uuid4().hex}"))
    had = fs.exists(target)
    if had and not fs.rename(target, aside):
        raise OSError(f"{path} could not be moved aside; the new rows are in {fresh}")
    if not fs.rename(source, target):
        if had and not fs.rename(aside, target):
            raise OSError(f"{fresh} could not be renamed to {path}; the old rows are in {aside.toString()}")
        raise OSError(f"{fresh} could not be renamed to {path}, which is as it was")
    if had:
        fs.delete(aside, True)


def restore_folder(spark: SparkSession, path: str) -> None:
    """Moves a folder back that a crashed `replace_folder` had moved aside and not replaced."""
    path = path.rstrip("/")
    parent, _, name = path.rpartition("/")
    if not parent or path_exists(spark, path):
        return
    for left in sorted(n for n in child_names(spark, parent) if n.startswith(f"{name}{ASIDE}")):
        fs, source = file_system(spark, f"{parent}/{left}")
        fs.rename(source, spark._jvm.org.apache.hadoop.fs.Path(path))
        return


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees: `spark.checkpoint.dir`, else one in the session's warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name for one run; the file system drops it when the application ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    fs, target = file_system(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    return path
