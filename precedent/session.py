"""Where intermediate results live, and how lineage is cut."""

import shutil
import tempfile
import uuid
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; a cluster
    session without it is refused, because a folder on one machine is lost with
    that machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder every executor can reach.")
    folder = tempfile.mkdtemp(prefix="precedent-")
    spark.conf.set("spark.checkpoint.dir", folder)
    context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage in reliable storage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """These settings of the session inside, what they were before afterwards."""
    before = {key: spark.conf.get(key) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


#: The shuffle files of a write are deleted as it ends.
CLEAN_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


class Tables:
    """Intermediate tables of one run, in a folder of their own under the shared folder.

    Later queries read the stored table, so the shuffle files of a write are deleted as it ends. Rows go to Python in
    batches of 8 MB, since rows that hold whole sets would fill some 64 MB a task on both sides.
    """

    SETTINGS = CLEAN_SHUFFLES | {"spark.sql.execution.arrow.maxBytesPerBatch": "8m"}

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, fresh_path(spark, name)
        self.paths: dict[str, str] = {}
        self.made = 0

    def store(self, df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
        """``df``, written once and read again. ``name`` stands for the newest table of that name."""
        self.made += 1
        path = f"{self.folder}/{name}-{self.made}"
        with settings(self.spark, self.SETTINGS):
            df.write.option("compression", codec).parquet(path)
        self.paths[name] = path
        return self.spark.read.parquet(path)

    def drop(self, *names: str) -> None:
        """Delete the newest tables of these names; nothing may read them any more."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application.

    The functions that run there are part of it. Spark's own file server hands the
    archive to every executor, also to ones that join later.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="precedent-py-")) / package.name
    archive = shutil.make_archive(str(target), "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)
