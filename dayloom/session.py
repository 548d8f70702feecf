"""Session helpers: builder, given tables, and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from dayloom.sources import paths

_LOCAL_SCRATCH: list[tempfile.TemporaryDirectory] = []
# what this process made under shared folders and has not deleted yet: paths, and databases in them
_FOLDERS: list[str] = []
_DATABASES: list[str] = []
# by application and folder, whether a trial found that all executors share it
_TRIED: dict[tuple[str, str], bool] = {}


def local_session(app: str, cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def read_given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder that every executor can reach.

    It lies under ``spark.checkpoint.dir``. Where that is unset, a session whose executors are on this machine gets a
    temporary folder, removed at exit, and any other one a folder beside its warehouse's tables. On a cluster a folder
    of the local file system, which may be a mounted one, is taken only after a trial: what all executors write there has
    to come back. ``scratch_scope`` deletes folders when a job ends, the end of the process the others.
    """
    _FOLDERS.append(f"{_scratch_root(spark).rstrip('/')}/dayloom-{uuid.uuid4().hex}")
    return _FOLDERS[-1]


def _scratch_root(spark: SparkSession) -> str:
    named, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
    one_machine = master.startswith("local")
    if named and (one_machine or not _is_local(spark, named)):
        return named
    if not named and one_machine:
        folder = tempfile.TemporaryDirectory(prefix="dayloom-")
        # where the default file system is another one, a path without a scheme would not be of this disk
        root = folder.name if _is_local(spark, folder.name) else f"file://{folder.name}"
        if not master.startswith("local-cluster") or _comes_back(spark, root):
            _LOCAL_SCRATCH.append(folder)
            return root
    root = named or spark.conf.get("spark.sql.warehouse.dir", None)
    if not root or _is_local(spark, root) and not _comes_back(spark, root):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return root


def _is_local(spark: SparkSession, path: str) -> bool:
    """A path without a scheme is local only where the default file system is, wherever that is configured."""
    if path.startswith("/"):
        return spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:").startswith("file:")
    return path.startswith("file:")


def _comes_back(spark: SparkSession, root: str) -> bool:
    """Whether the files that the tasks of a small job write below the folder are all there for the next one."""
    try:
        key = (spark.sparkContext.applicationId, root)
        if key not in _TRIED:
            path, n = f"{root.rstrip('/')}/dayloom-{uuid.uuid4().hex}", 4 * spark.sparkContext.defaultParallelism
            _FOLDERS.append(path)
            spark.range(0, n, 1, n).write.parquet(path)
            _TRIED[key] = spark.read.schema("id bigint").parquet(path).count() == n
        return _TRIED[key]
    except Exception:  # a folder that cannot be written is not shared either
        return False


def scratch_database(spark: SparkSession) -> str:
    """A new database located in the scratch folder, so that its managed tables are shared too."""
    name = f"dayloom_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_folder(spark)}'")
    _DATABASES.append(name)
    return name


def stored(df: DataFrame) -> DataFrame:
    """The frame written to the scratch folder and read back, so that several uses compute it once.

    Unlike a cached frame it survives the loss of executors and holds no memory.
    """
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete what was stored in the body when it ends, also by an error. Its results must be written by then."""
    folders, databases = len(_FOLDERS), len(_DATABASES)
    try:
        yield
    finally:
        _clean(spark, folders, databases)


def _clean(spark: SparkSession, folders: int = 0, databases: int = 0) -> None:
    while len(_DATABASES) > databases:
        spark.sql(f"DROP DATABASE IF EXISTS {_DATABASES.pop()} CASCADE")
    while len(_FOLDERS) > folders:
        paths.delete(spark, _FOLDERS.pop())


@atexit.register
def _clean_at_exit() -> None:
    spark = SparkSession.getActiveSession() if _FOLDERS else None
    if spark is not None:
        with contextlib.suppress(Exception):  # the JVM may be gone already
            _clean(spark)
