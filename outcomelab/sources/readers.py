"""Readers.  NaN becomes NULL on the way in; an empty CSV field already is NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.shape import missing_as_null, require_columns

# Tried in this order.  The UTF-8 reader drops a byte-order mark by itself, and
# ISO-8859-1 accepts any byte, so nothing after it could ever be reached.
ENCODINGS = ("UTF-8", "ISO-8859-1")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             null_value: str | None = None, encoding: str = "UTF-8") -> DataFrame:
    """CSV with a header.  A declared schema avoids the extra inference scan."""
    reader = spark.read.option("header", True).option("encoding", encoding)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return missing_as_null(reader.csv(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return missing_as_null(spark.read.parquet(path))


def read_pair(spark: SparkSession, folder: str, schema: T.StructType | None = None,
              required: Sequence[str] = (), target: str | None = None,
              null_value: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``train.csv`` and ``test.csv`` of a folder, checked before anything runs.

    Both need the ``required`` columns; only the training table needs the target.
    """
    test_schema = None
    if schema is not None:
        test_schema = T.StructType([f for f in schema.fields if f.name != target])
    train = read_csv(spark, f"{folder}/train.csv", schema, null_value)
    test = read_csv(spark, f"{folder}/test.csv", test_schema, null_value)
    require_columns(train, [*required, *([target] if target else [])], "training table")
    require_columns(test, required, "test table")
    return train, test


def _damaged(lines: DataFrame, encoding: str) -> Column:
    """Whether the raw bytes of ``value`` cannot be text of the encoding."""
    name = encoding.lower().replace("_", "-")
    if name in ("utf-8", "utf8", "utf-8-sig"):
        return ~F.is_valid_utf8("value")
    if name in ("iso-8859-1", "latin1", "latin-1"):
        return F.lit(False)
    one_to_one = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    if name in ("us-ascii", "ascii"):
        return one_to_one.rlike("[^\\x00-\\x7F]")
    if name in ("windows-1252", "cp1252"):
        return one_to_one.rlike("[\\x81\\x8D\\x8F\\x90\\x9D]")
    raise ValueError(f"no byte check for {encoding}")


def detect_encoding(spark: SparkSession, path: str,
                    encodings: Sequence[str] = ENCODINGS) -> str:
    """The first encoding whose rules the bytes of the whole file keep.

    A distributed scan looks at raw bytes, not at decoded text, so a character that
    merely looks like a decoding mark is no error and any bad byte is found.  Lines are
    read by any number of tasks: a line end never lies inside a character of these
    encodings, so no state has to pass from one line, or split, to the next.
    """
    lines = spark.read.text(path)
    for encoding in encodings:
        if not lines.where(_damaged(lines, encoding)).limit(1).collect():
            return encoding
    raise ValueError(f"none of {list(encodings)} decodes {path}")


def read_csv_any_encoding(spark: SparkSession, path: str,
                          schema: T.StructType | str | None = None,
                          encodings: Sequence[str] = ENCODINGS) -> tuple[DataFrame, str]:
    """The table and the encoding that worked."""
    encoding = detect_encoding(spark, path, encodings)
    return read_csv(spark, path, schema, encoding=encoding), encoding
