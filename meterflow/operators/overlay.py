"""Merge of an overlay table into a base table by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from meterflow.functions.keys import require_unique
from meterflow.functions.paths import column


def overlay(base: DataFrame, *overlays: DataFrame, key: str = "name", check_unique: bool = True) -> DataFrame:
    """Rows of all tables merged by ``key``; unmatched overlay rows are appended. Keys are unique.

    Values present in an overlay replace the base's, structs merge field by field, lists are
    appended, and lists of structs with a ``name`` field are merged by that name. With several
    overlays the first one listed is applied last and wins.
    """
    # each input is checked once; the full outer join of unique keys has unique keys
    base, *rest = [require_unique(t, key, check_unique) for t in (base, *overlays)]
    for extension in reversed(rest):
        base = _overlay(base, extension, key)
    return base


def _overlay(base: DataFrame, extension: DataFrame, key: str) -> DataFrame:
    left = base.select(column((key,)).alias("_key"), F.struct(*map(_named, base.columns)).alias("_base"))
    right = extension.select(column((key,)).alias("_key"), F.struct(*map(_named, extension.columns)).alias("_ext"))
    types = {f.name: f.dataType for f in base.schema.fields}
    new = {f.name: f.dataType for f in extension.schema.fields}
    columns = []
    for name in dict.fromkeys([*types, *new]):
        if name == key:
            value = F.col("_key")
        elif name not in new:
            value = column(("_base", name))
        elif name not in types:
            value = column(("_ext", name))
        else:
            value = merge(column(("_base", name)), types[name], column(("_ext", name)), new[name])
        columns.append(value.alias(name))
    return left.join(right, "_key", "full_outer").select(*columns)


def _named(name: str) -> Column:
    return column((name,)).alias(name)


def merge(base: Column, btype: T.DataType, ext: Column, etype: T.DataType) -> Column:
    """Merged value of two fields that may be missing."""
    if isinstance(btype, T.StructType) and isinstance(etype, T.StructType):
        left = {f.name: f.dataType for f in btype.fields}
        right = {f.name: f.dataType for f in etype.fields}
        fields = []
        for name in dict.fromkeys([*left, *right]):
            if name not in right:
                value = base.getField(name)
            elif name not in left:
                value = ext.getField(name)
            else:
                value = merge(base.getField(name), left[name], ext.getField(name), right[name])
            fields.append(value.alias(name))
        return F.when(base.isNotNull() | ext.isNotNull(), F.struct(*fields))
    if isinstance(btype, T.ArrayType) and isinstance(etype, T.ArrayType):
        joined = _merge_named(base, btype, ext, etype) if _has_name(btype) and _has_name(etype) else F.concat(base, ext)
        return F.when(base.isNull(), _like(ext, etype, btype)).when(ext.isNull(), base).otherwise(joined)
    return F.coalesce(ext, base)


def _has_name(dtype: T.ArrayType) -> bool:
    return isinstance(dtype.elementType, T.StructType) and "name" in dtype.elementType.names


def _like(ext: Column, etype: T.ArrayType, btype: T.ArrayType) -> Column:
    if not (_has_name(etype) and _has_name(btype)):
        return ext
    blank = F.lit(None).cast(btype.elementType)
    return F.transform(ext, lambda e: merge(blank, btype.elementType, e, etype.elementType))


def _merge_named(base: Column, btype: T.ArrayType, ext: Column, etype: T.ArrayType) -> Column:
    nothing = F.lit(None).cast(etype.elementType)

    def update(item: Column) -> Column:
        same = F.get(F.filter(ext, lambda e: e.getField("name") == item.getField("name")), F.lit(0))
        return merge(item, btype.elementType, F.coalesce(same, nothing), etype.elementType)

    added = F.filter(ext, lambda e: ~F.exists(base, lambda b: b.getField("name").eqNullSafe(e.getField("name"))))
    return F.concat(F.transform(base, update), _like(added, etype, btype))
