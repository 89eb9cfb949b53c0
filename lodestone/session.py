"""Session settings, table access and the shared scratch area.

Every operator takes a live ``SparkSession`` and returns a lazy ``DataFrame``.  Lineage that is
expensive or nondeterministic to recompute is cut by :func:`materialize`, which writes a Parquet
table into the folder named by ``spark.checkpoint.dir``.  That folder is shared by the driver and all
executors, so the loss of an executor never loses the table.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

_own_dirs: dict[str, str] = {}


def build_session(app: str = "lodestone", cpus: str | int = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the library is tuned for."""
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    session = SparkSession.builder.master(f"local[{cpus}]").appName(app).config(map=settings).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def share_code(spark: SparkSession) -> None:
    """Lets Python workers find this package where the driver found it, if that place exists for them.

    On a cluster without a shared installation, submit the package with ``--py-files``.
    """
    home, env = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        env["PYTHONPATH"] = os.pathsep.join([home, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory; the path may be any URI that Spark can read."""
    share_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def require_tables(spark: SparkSession, sf_dir: str, names: list[str]) -> None:
    """Raises an error that lists the tables which a data directory lacks."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    places = {n: jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{n}.parquet") for n in names}
    if lost := [n for n, p in places.items() if not p.getFileSystem(conf).exists(p)]:
        raise FileNotFoundError(f"{sf_dir} lacks {', '.join(sorted(lost))}")


def scratch_root(spark: SparkSession) -> str:
    """The shared scratch folder of this application.

    The cluster names it in ``spark.checkpoint.dir``.  Only a single-JVM local session, where all
    threads share one disk, may fall back to a temporary folder.
    """
    root = spark.sparkContext.getConf().get(CHECKPOINT_KEY) or spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"{CHECKPOINT_KEY} must name a folder shared by all executors")
        root = _own_dirs.get(spark.sparkContext.applicationId)
        if root is None:
            root = "file://" + tempfile.mkdtemp(prefix="lodestone-")
            _own_dirs[spark.sparkContext.applicationId] = root
            spark.sparkContext.setCheckpointDir(root)
            atexit.register(_remove_tree, root.removeprefix("file://"))
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"


def _remove_tree(path: str) -> None:
    import shutil

    shutil.rmtree(path, ignore_errors=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` into the scratch folder and return a scan of it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    schema = df.schema
    df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._scratch_path = path
    return out


def delete(spark: SparkSession, path: str) -> None:
    """Removes a path from any file system of Spark."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def discard(df: DataFrame) -> None:
    """Deletes a table that :func:`materialize` wrote and that nothing reads any more."""
    if path := getattr(df, "_scratch_path", None):
        delete(df.sparkSession, path)


def clean(spark: SparkSession) -> None:
    """Deletes all scratch tables of this application; call it when its results have been written elsewhere."""
    delete(spark, scratch_root(spark))


def cores(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


def data_dir(default: str = "/root/testdata/sf0.001") -> str:
    return os.environ.get("LODESTONE_DATA", default)
