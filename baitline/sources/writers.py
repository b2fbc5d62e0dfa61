"""Writers. Outputs are folders, written by all tasks at once."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baitline.schemas import TRAINING_COLUMNS


def _write_csv(df: DataFrame, path: str) -> None:
    # Blanks at the ends of a field are part of it.
    (df.write.mode("overwrite").option("header", True).option("quote", '"')
     .option("escape", '"').option("emptyValue", "").option("nullValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_training_csv(df: DataFrame, path: str) -> None:
    _write_csv(df.select(TRAINING_COLUMNS), path)


def write_url_testset(df: DataFrame, path: str) -> None:
    _write_csv(df.select("url", "y_true"), path)


def write_eval_template(df: DataFrame, path: str) -> None:
    """The test set with an empty column to fill with predictions."""
    _write_csv(df.select("url", "y_true", F.lit(None).cast("string").alias("y_pred")), path)


def write_url_predictions(df: DataFrame, path: str) -> None:
    _write_csv(df.select("url", "y_true", "y_pred", "url_score"), path)


def write_metrics_json(df: DataFrame, path: str) -> None:
    """A metric table has one row (or one per epoch): one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_verdicts(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("risk_level").parquet(path)


def write_rejected(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _files(spark: SparkSession, path: str):
    held = spark._jvm.org.apache.hadoop.fs.Path(path)
    return held.getFileSystem(spark._jsc.hadoopConfiguration()), held


def newest_version(spark: SparkSession, path: str) -> int:
    """Number of the newest manifest, 0 if there is none."""
    files, folder = _files(spark, f"{path}/manifests")
    names = [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []
    return max((int(n[:-5]) for n in names if re.fullmatch(r"\d+\.json", n)), default=0)


def publish(tables: dict[str, DataFrame], path: str) -> int:
    """Write several tables that become visible together, or not at all: the number of the version.

    The tables go to a folder of their own, which nobody reads until the manifest names it; the manifest
    appears by one rename. A job that fails in between removes its folder (and if it cannot, the folder stays unread);
    a retry writes a version of its own. Of two jobs that finish at once one takes the next number.
    """
    spark = next(iter(tables.values())).sparkSession
    name = uuid.uuid4().hex
    try:
        for table, df in tables.items():
            df.write.parquet(f"{path}/versions/{name}/{table}")
        files, staged = _files(spark, f"{path}/manifests/_{name}")
        out = files.create(staged, False)
        out.write(bytearray(json.dumps({"folder": f"versions/{name}", "tables": sorted(tables)}).encode()))
        out.close()
    except BaseException:
        files, folder = _files(spark, f"{path}/versions/{name}")
        files.delete(folder, True)
        raise
    number = newest_version(spark, path) + 1
    while True:
        target = _files(spark, f"{path}/manifests/{number:08d}.json")[1]
        if not files.exists(target) and files.rename(staged, target):
            return number
        number += 1


def read_published(spark: SparkSession, path: str, table: str, version: int | None = None) -> DataFrame:
    """A table of the newest version, or of the one named."""
    version = version or newest_version(spark, path)
    if not version:
        raise FileNotFoundError(f"nothing published at {path}")
    said = "\n".join(r[0] for r in spark.read.text(f"{path}/manifests/{version:08d}.json").collect())
    return spark.read.parquet(f"{path}/{json.loads(said)['folder']}/{table}")


def publish_verdicts(verdicts: DataFrame, rejected: DataFrame, path: str) -> int:
    """Verdicts and rejected mails of one run, visible together."""
    return publish({"verdicts": verdicts, "rejected": rejected}, path)
