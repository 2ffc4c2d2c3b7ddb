"""Characterization-ready documents as a stream, an extension beyond the batch engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataform.operators.normalize import normalize
from strataform.operators.quality import quality_score


def read_documents(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """New Parquet files of a folder as a stream of documents."""
    return spark.readStream.schema(schema).parquet(folder)


def normalized_stream(documents: DataFrame, at: str = "fetched_at", late: str = "1 day") -> DataFrame:
    """Documents normalized and scored; a text seen again within the watermark is dropped."""
    rows = normalize(documents.withWatermark(at, late))
    scored = rows.withColumn("quality_score", quality_score(F.length("normalized_text")))
    return scored.dropDuplicatesWithinWatermark(["normalized_checksum"])


def write_stream(rows: DataFrame, folder: str, checkpoint: str):
    """Append the stream to a folder, all that is there now and then stop."""
    return rows.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
