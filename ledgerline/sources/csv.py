"""SRC-3: read delimited raw exports, keeping the bad rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"
#: How a null is written in a raw export, apart from an empty string.
NULL = "\\N"


def load_csv(spark: SparkSession, path: str, schema: StructType | str,
             header: bool = True, sep: str = ",",
             corrupt_column: str = CORRUPT, null_value: str = NULL) -> DataFrame:
    """Read CSV with a fixed schema in PERMISSIVE mode.

    A value that does not parse becomes null and the raw line is kept in
    ``corrupt_column`` (null for good lines), so nothing is silently lost.
    The schema is never inferred: inference reads the data twice and guesses.
    ``null_value`` and unquoted empty fields are null, a quoted empty field is
    the empty string.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if corrupt_column not in schema.fieldNames():
        schema = StructType(list(schema.fields) + [StructField(corrupt_column, StringType())])
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt_column)
        .option("nullValue", null_value)
        .option("emptyValue", "")
        .csv(path)
    )
