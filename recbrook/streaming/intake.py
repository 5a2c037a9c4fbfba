"""Message intake: JSON messages parsed against a declared schema, with
malformed messages routed aside instead of failing the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BASE

EVENT_SCHEMA = BASE["events"]
CORRUPT = "_corrupt"
# Fixed value: full microsecond precision for timestamps in JSON.
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def to_messages(df: DataFrame) -> DataFrame:
    """One JSON text per row (``value``), the message form of a table."""
    return df.select(F.to_json(F.struct(*df.columns), JSON_OPTIONS).alias("value"))


def parse_messages(raw: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, malformed raw messages) from a ``value`` text column."""
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    opts = dict(JSON_OPTIONS, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    parsed = raw.select(F.from_json("value", with_corrupt, opts).alias("m"), "value")
    bad_cond = F.col("m").isNull() | F.col(f"m.{CORRUPT}").isNotNull()
    good = parsed.filter(~bad_cond).select(*[F.col(f"m.{f.name}").alias(f.name) for f in schema.fields])
    bad = parsed.filter(bad_cond).select("value")
    return good, bad


def message_stream(spark: SparkSession, path: str) -> DataFrame:
    """A streaming frame of raw JSON lines arriving as files under ``path``."""
    return spark.readStream.schema("value string").text(path)
