"""JSON and raw text payloads, from files or from text columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from meterflow.functions.paths import column


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Records of JSON files holding one object or one array each."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_text(spark: SparkSession, path: str, field: str = "message") -> DataFrame:
    """Each file as one record with its whole content in one field."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", field)


def infer_json_type(df: DataFrame, name: str) -> T.DataType:
    """Merged type of all documents in a JSON text column, decimals widened to double.

    One pass over the column with map-side combining; only the type reaches the driver. Malformed documents fail it.
    """
    shape = df.agg(F.schema_of_variant_agg(F.parse_json(column((name,)))).alias("t")).first()["t"]
    return _widened(T._parse_datatype_string(_SHAPE.sub(lambda m: _TYPES.get(m.group(), m.group()), shape)))


# type words of a variant's shape; quoted names and names before a colon are no types
_SHAPE = re.compile(r"`(?:[^`]|``)*`|\bOBJECT(?=<)|\bVOID\b(?!\s*:)")
_TYPES = {"OBJECT": "STRUCT", "VOID": "STRING"}


def _widened(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _widened(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_widened(dtype.elementType))
    return T.DoubleType() if isinstance(dtype, T.DecimalType) else dtype


def json_records(
    df: DataFrame, name: str, schema: T.StructType | str | None = None, keep: Sequence[str] = (), malformed: str = "fail"
) -> DataFrame:
    """Records of a JSON text column; an array gives one record per element, a null document none.

    A malformed document, or one that does not fit the schema, fails the job; ``malformed="drop"`` leaves it out.
    Without a schema the column is read once more to derive it from all documents: give one for large tables.
    """
    if malformed not in ("fail", "drop"):
        raise ValueError("malformed must be fail or drop")
    if schema is None:
        known = df if malformed == "fail" else df.where(F.try_parse_json(column((name,))).isNotNull())
        schema = infer_json_type(known, name)
    elif isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    element = schema.elementType if isinstance(schema, T.ArrayType) else schema
    if not isinstance(element, T.StructType):
        raise ValueError("records are JSON objects")
    # an array schema also accepts a single object
    parsed = F.from_json(column((name,)), T.ArrayType(element), {"mode": "FAILFAST" if malformed == "fail" else "PERMISSIVE"})
    rows = df.select(*[column((k,)) for k in keep], F.explode(parsed).alias("_record"))
    return rows.select(*[column((k,)) for k in keep], "_record.*")


def text_records(df: DataFrame, name: str, field: str = "message", keep: Sequence[str] = ()) -> DataFrame:
    """Whole text of a column as one field per record."""
    return df.select(*[column((k,)) for k in keep], column((name,)).alias(field))
