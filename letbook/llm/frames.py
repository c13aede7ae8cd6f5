"""Small helpers on tables that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from letbook.session import keep

__all__ = ["discard", "fold", "keep", "let", "lower_ascii", "table"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id's text modulo `folds`; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def let(value: Column, use) -> Column:
    """use(x) with x bound to the value, so that lambdas inside do not compute it again."""
    return F.transform(F.array(value), use)[0]


def discard(*tables: DataFrame) -> None:
    """Deletes kept tables that nothing reads any more, and lets go of the shuffles that made them."""
    for rows in tables:
        jvm = rows.sparkSession._jvm
        for folder in {f.rsplit("/", 1)[0] for f in rows.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(rows.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
        jvm.System.gc()
