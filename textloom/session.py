"""Sessions, and the shared folder in which jobs keep what they must not recompute."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []


def get_session(app: str = "textloom", **conf: str) -> SparkSession:
    """A session with the engine's defaults: adaptive plans, ANSI arithmetic, UTC."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share (spark.checkpoint.dir).

    Only a local master may go without the setting: there, one temporary folder serves
    the process. On a cluster a missing setting is an error, since a machine's own
    temporary folder is not visible to the others.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        if not _LOCAL:
            _LOCAL.append(tempfile.mkdtemp(prefix="textloom-"))
        found = f"file://{_LOCAL[0]}"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found


def spread(df: DataFrame) -> DataFrame:
    """df over all cores where its files give fewer tasks than four a core, for work that is dear a row; else as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < 4 * cores else df


class Workspace:
    """Tables written to the shared folder, to cut lineage and to be read more than once.

    A written table survives lost executors. Tables stay until the process ends, because
    a lazy result may still read them; `drop` removes those known to be done with.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/textloom-{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        atexit.register(self.drop, self.root)

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def keep(self, df: DataFrame, name: str = "table", **options: str) -> DataFrame:
        """Write df once; what is returned reads the written table."""
        at = self.path(name)
        df.write.options(**options).parquet(at)
        out = self.spark.read.schema(df.schema).parquet(at)
        out._textloom_path = at
        return out

    def keep_bucketed(self, df: DataFrame, name: str, buckets: int, by: str) -> DataFrame:
        """Write df once as a table in so many buckets by a column; its name leaves the catalog when the process ends."""
        df.write.format("parquet").option("path", self.path(name)).option("compression", "none").bucketBy(buckets, by).saveAsTable(name)
        atexit.register(self._forget, name)
        return self.spark.table(name)

    def _forget(self, name: str) -> None:
        try:
            self.spark.sql(f"drop table if exists {name}")
        except Exception:  # noqa: BLE001  the session ended before this hook ran
            return

    def drop(self, what: DataFrame | str) -> None:
        """Remove a table that keep() returned, or a path; silent when Spark is gone."""
        at = what if isinstance(what, str) else what._textloom_path
        try:
            jvm = self.spark.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001  the session ended before this hook ran
            return
