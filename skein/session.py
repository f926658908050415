"""Session helpers: module shipping, shared folders and written stages."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where the cluster has not installed it.

    Workers on the same file system get the repository on their path; a
    cluster without one installs the package or passes it with --py-files.
    """
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)
    if ROOT not in sys.path:
        sys.path.insert(0, ROOT)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a folder of our own only where that is unset and all runs in one process."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="skein-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def stages_dir(spark: SparkSession) -> str:
    """The folder below the shared one that holds this application's written stages."""
    return f"{shared_dir(spark)}/skein-{spark.sparkContext.applicationId}"


_TOGETHER = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB"}


def materialize(df: DataFrame, name: str, together: bool = False) -> DataFrame:
    """Write df below the shared folder and read it back: lineage ends, lost executors cost nothing.

    What df shuffled is deleted once it is written: it is in the shared folder
    now, and shuffle files would otherwise stay until the driver happens to
    collect its garbage. With together, rows that df deals by some columns stay
    where they are in joins whose keys include those columns, and the other side
    is sent to them; a side whose parts all turn out small is hashed, so that the
    rows are not sorted.
    """
    spark = df.sparkSession
    path = f"{stages_dir(spark)}/{name}-{uuid.uuid4().hex}"
    meant = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"} | (_TOGETHER if together else {})
    before = {k: spark.conf.get(k) for k in meant}
    for k, v in meant.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete what materialize wrote for df, once nothing will read it again."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_stages(spark: SparkSession) -> None:
    """Delete this application's written stages, on whatever store they are; call it once the results of its queries are written.

    Frames that queries returned before can no longer be read.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(stages_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
