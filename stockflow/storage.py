"""Locations: shared work folder, stored intermediates, path checks."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Characters Spark escapes in partition folder names.
_ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(code) for code in range(1, 32)}

_folders: dict[str, str] = {}


def set_shared_folder(spark: SparkSession, folder: str | None = None) -> None:
    """Name the folder for a session without ``spark.checkpoint.dir``, as in tests.

    Without a name it is a new temporary folder, which only a local master may use.
    A session that has the setting keeps it.
    """
    application = spark.sparkContext.applicationId
    if spark.conf.get("spark.checkpoint.dir", None) or application in _folders:
        return
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        folder = tempfile.mkdtemp(prefix="stockflow-")
    _folders[application] = folder.rstrip("/")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Without it, and without a call of ``set_shared_folder``, this is an error: a
    machine-local folder would not be seen by the executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or _folders.get(spark.sparkContext.applicationId)
    if not folder:
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    return folder.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared folder and read them back.

    Cuts the lineage with a table that outlives any executor; later reads prune
    columns and push filters down, which a checkpoint's rows do not allow.
    """
    spark = rows.sparkSession
    path = work_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def discard(rows: DataFrame) -> None:
    """Delete what ``stored`` wrote for these rows, which nothing may read again."""
    files = rows.inputFiles()
    if files:
        drop(rows.sparkSession, files[0].rpartition("/")[0])


def partition_dir(root: str, **values: object) -> str:
    """Path of one Hive partition below ``root``, named as Spark names it."""

    def escaped(value: object) -> str:
        return "".join(
            f"%{ord(char):02X}" if char in _ESCAPED else char for char in str(value)
        )

    parts = [f"{name}={escaped(value)}" for name, value in values.items()]
    return "/".join([root.rstrip("/"), *parts])


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whatever file system it names."""
    system, location = _file_system(spark, path)
    return system.exists(location)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches a pattern with wildcards."""
    system, location = _file_system(spark, pattern)
    return bool(system.globStatus(location))


def children(spark: SparkSession, pattern: str, whole: bool = False) -> list[str]:
    """The names, or ``whole`` paths, that match a pattern with wildcards, ascending."""
    system, location = _file_system(spark, pattern)
    found = [status.getPath() for status in system.globStatus(location) or []]
    return sorted(path.toString() if whole else path.getName() for path in found)


def make_folder(spark: SparkSession, path: str) -> None:
    """Create an empty folder, if it does not exist."""
    system, location = _file_system(spark, path)
    system.mkdirs(location)


def bytes_below(spark: SparkSession, path: str) -> int:
    """The bytes of all files below a path; 0 for none."""
    system, location = _file_system(spark, path)
    return system.getContentSummary(location).getLength() if system.exists(location) else 0


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a path in one step, unless the target exists; says whether it did."""
    system, location = _file_system(spark, target)
    system.mkdirs(location.getParent())
    fs = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    context = fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(_file_system(spark, source)[1], location, options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def drop(spark: SparkSession, path: str) -> None:
    """Delete a path recursively, if it exists."""
    system, location = _file_system(spark, path)
    system.delete(location, True)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read a partitioned Parquet table; a missing one has no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
