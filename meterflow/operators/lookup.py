"""Lookup enrichment: merge the fields of a keyed table into metric attributes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from meterflow import frame
from meterflow.functions.keys import no_spread, null_spread, require_unique, row_hash
from meterflow.functions.paths import column
from meterflow.functions.values import b64, b64url, common_type, literal, shared_type, shown, truthy

ENCODERS = {"b64": b64, "b64url": b64url}


def keyed_documents(dim: DataFrame, key: str, check: bool = True) -> DataFrame:
    """``dim`` as ``_lookup, _doc`` with unique keys."""
    fields = [column((c,)).alias(c) for c in dim.columns if c != key]
    docs = require_unique(dim, key, check)
    return docs.select(column((key,)).alias("_lookup"), F.struct(*fields).alias("_doc"))


def enrich(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str,
    include: Sequence[str] | None = None,
    defaults: Mapping[str, object] | None = None,
    encode: str | None = None,
    fail: bool = False,
    falsy_as_missing: bool = True,
    salts: int = 1,
    within: Column | None = None,
    check_unique: bool = True,
    sep: str = ".",
) -> DataFrame:
    """Merge the document found under ``key`` over the attributes of each metric.

    Without ``include`` every document field is merged and missing documents change nothing. With
    ``include`` exactly these fields are set, a missing field (and, with ``falsy_as_missing``, a
    zero, false or empty one) taking its default, else null. ``encode`` applies ``b64`` or
    ``b64url`` to the key first. ``fail`` stops the job at the first key without a document.

    The join strategy is left to Spark, which broadcasts ``dim`` only when its size is known to be
    small and splits skewed partitions at run time. ``salts`` > 1 additionally spreads every key
    over that many partitions by replicating ``dim``, for hot keys against a large table. Rows
    outside ``within`` are not looked up and keep their fields. A key occurring twice in ``dim`` fails
    the job, unless ``check_unique`` is off for keys known to be unique.
    """
    value, dtype = frame.field(df, key, sep)
    if encode:
        value = ENCODERS[encode](value.cast("string"))
    if within is not None:
        value = F.when(within, value)
    right = keyed_documents(dim, dim_key, check_unique)
    schema: T.StructType = right.schema["_doc"].dataType
    left, on = df.withColumn("_lookup", value), ["_lookup", "_spread"]
    left = left.withColumn("_spread", null_spread(left, F.col("_lookup")))
    right = right.withColumn("_spread", no_spread(F.col("_lookup")))
    if salts > 1:
        left = left.withColumn("_salt", F.pmod(row_hash(df), F.lit(salts)).cast("int"))
        # Spark sizes the replicated side as if it were not replicated, so it would broadcast it whole at
        # every size; salts are for a shuffled join, which spills instead of holding ``salts`` times ``dim``
        right = right.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)]))).hint("merge")
        on.append("_salt")
    joined = left.join(right.withColumn("_hit", F.lit(True)), on, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    if fail:
        lost = F.raise_error(F.concat(F.lit("no document for key "), F.coalesce(F.col("_lookup").cast("string"), F.lit("null"))))
        needed = ~hit if within is None else within & ~hit
        joined = joined.where(F.when(needed, lost.cast("boolean")).otherwise(True))
    return merged_documents(df, joined, schema, hit, include, defaults, falsy_as_missing, within)


def merged_documents(
    df: DataFrame, joined: DataFrame, schema: T.StructType, hit: Column, include: Sequence[str] | None,
    defaults: Mapping[str, object] | None, falsy_as_missing: bool, within: Column | None,
) -> DataFrame:
    """Rows of ``joined``, which are those of ``df`` beside their ``_doc``, with the document's fields merged in."""
    values: dict[str, Column] = {}
    if include is None:
        known = _field_names(df)
        for f in schema.fields:
            found = column(("_doc", f.name))
            values[f.name] = F.when(hit, found).otherwise(_own(df, f.name)) if f.name in known else found
    else:
        types = {f.name: f.dataType for f in schema.fields}
        for name in include:
            default = (defaults or {}).get(name)
            if name not in types:
                values[name] = literal(default)
                continue
            found = column(("_doc", name))
            usable = truthy(found, types[name]) if falsy_as_missing else found.isNotNull()
            # a default of another type gives both one type
            kind = types[name] if default is None or isinstance(default, (Mapping, list, tuple, Column)) else shared_type(types[name], common_type([default]))
            text_default = isinstance(kind, T.StringType) and default is not None and not isinstance(default, (str, Column))
            fallback = F.lit(str(default)) if text_default else literal(default).cast(kind)
            values[name] = F.when(usable, shown(found, types[name], kind)).otherwise(fallback)
    if within is not None:
        known = _field_names(df)
        values = {n: F.when(within, v).otherwise(_own(df, n) if n in known else F.lit(None)) for n, v in values.items()}
    out = frame.merge_fields(joined, values)
    return out.select(*[column((c,)) for c in _ordered(df, values)])


def missing_keys(df: DataFrame, dim: DataFrame, key: str, dim_key: str, encode: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key has no document."""
    value, _ = frame.field(df, key)
    if encode:
        value = ENCODERS[encode](value.cast("string"))
    keys = dim.select(column((dim_key,)).alias("_lookup"))
    return df.withColumn("_lookup", value).join(keys, "_lookup", "left_anti").drop("_lookup")


def _field_names(df: DataFrame) -> list[str]:
    return frame.attribute_schema(df).fieldNames() if frame.is_frame(df) else df.columns


def _own(df: DataFrame, name: str) -> Column:
    return column((frame.ATTRIBUTES, name)) if frame.is_frame(df) else column((name,))


def _ordered(df: DataFrame, values: Mapping[str, Column]) -> list[str]:
    return df.columns if frame.is_frame(df) else [*df.columns, *[n for n in values if n not in df.columns]]
