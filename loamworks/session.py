"""What a session needs: the package on its executors, and staged tables in the cluster's shared folder.

Staged tables are Parquet folders under the folder that the session names in
``spark.checkpoint.dir``; all executors and the driver see it, so a lost executor
costs a re-read and not a recomputation of the whole lineage.
"""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application; they need not have it installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = Path(__file__).parent
    path = Path(tempfile.mkdtemp(prefix="spark-"), f"{top.name}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, file.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a local session that names none (tests) gets a temporary one; on a cluster that is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "local")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def staged(df: DataFrame, label: str, partition: str | None = None, **options: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, in folders by ``partition`` if one is named, and read back: short lineage, no recomputation."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    (df.write.partitionBy(partition) if partition else df.write).options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the folder of a staged table that nothing reads any more, through the file system that holds it."""
    spark = df.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
