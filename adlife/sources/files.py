"""File sources: JSON lines and JSON documents, always with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per line -> typed rows (no inference pass over the data)."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType | str,
                        whole_text: bool = True) -> DataFrame:
    """JSON documents -> one row per document with column ``doc`` of ``schema``.

    ``whole_text`` reads each file as one document (pretty-printed files);
    otherwise every line is a document. Unparsable documents give a null
    ``doc`` instead of failing the job.
    """
    text = spark.read.text(path, wholetext=whole_text)
    return text.select(F.from_json("value", schema).alias("doc"), F.col("value"))
