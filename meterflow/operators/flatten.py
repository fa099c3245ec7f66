"""Nested records to flat columns or to key/value rows, and nested updates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from meterflow import frame
from meterflow.functions.paths import Path, column, find, leaves, quoted

set_field = frame.set_field
drop_field = frame.drop_field
merge_fields = frame.merge_fields


def flat_columns(
    schema: T.StructType, sep: str = ".", max_array: int | None = None, base: Path = (), maps: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, Column]:
    """Flat name to column for every leaf; arrays give ``max_array`` numbered columns, a longer one fails the job.

    Without ``max_array`` arrays are refused, as columns cannot follow their lengths. ``maps`` has the keys of maps by their
    flat names: each gives a column, null where the key is missing, and another key fails the job. Other maps stay columns.
    """
    flat: dict[str, Column] = {}
    for path, dtype in leaves(schema):
        _flatten_into(flat, sep.join(path), column((*base, *path)), dtype, sep, max_array, maps or {})
    return flat


def _flatten_into(
    flat: dict[str, Column], name: str, value: Column, dtype: T.DataType, sep: str, max_array: int | None, maps: Mapping[str, Sequence[str]],
) -> None:
    if isinstance(dtype, T.ArrayType):
        if max_array is None:
            raise ValueError(f"list {name!r} needs max_array, or flatten_array for any length")
        longer = F.raise_error(F.lit(f"list {name} is longer than {max_array}")).cast(dtype)
        value = F.when(F.size(value) > max_array, longer).otherwise(value)
        for i in range(max_array):
            _flatten_into(flat, f"{name}{sep}{i}", F.get(value, F.lit(i)), dtype.elementType, sep, max_array, maps)
    elif isinstance(dtype, T.StructType):
        for f in dtype.fields:
            _flatten_into(flat, f"{name}{sep}{f.name}", value.getField(f.name), f.dataType, sep, max_array, maps)
    elif isinstance(dtype, T.MapType) and name in maps:
        known = F.array(*[F.lit(k).cast(dtype.keyType) for k in maps[name]])
        strange = F.size(F.array_except(F.map_keys(value), known)) > 0
        failure = F.raise_error(F.concat(F.lit(f"map {name} has other keys: "), F.array_join(F.array_except(F.map_keys(value), known).cast("array<string>"), ", "))).cast(dtype)
        value = F.when(strange, failure).otherwise(value)
        for k in maps[name]:
            _flatten_into(flat, f"{name}{sep}{k}", F.try_element_at(value, F.lit(k).cast(dtype.keyType)), dtype.valueType, sep, max_array, maps)
    else:
        flat[name] = value


def flatten(df: DataFrame, sep: str = ".", max_array: int | None = None, maps: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """All nested leaves as top-level columns whose names are joined by ``sep``.

    Column counts are fixed by the plan, so arrays need an upper length and maps their keys (see ``known_keys``); a longer
    list or another key fails the job. Use ``flatten_array`` for arrays of any length.
    """
    flat = flat_columns(df.schema, sep, max_array, maps=maps)
    return df.select([c.alias(n) for n, c in flat.items()])


def known_keys(df: DataFrame, name: str, most: int = 1000) -> list[str]:
    """The keys a map column has anywhere, sorted; more than ``most`` are refused."""
    keys = df.select(F.explode(F.map_keys(column((name,))).cast("array<string>")).alias("k")).distinct().limit(most + 1).collect()
    if len(keys) > most:
        raise ValueError(f"map {name!r} has more than {most} keys")
    return sorted(r["k"] for r in keys)


def flatten_array(
    df: DataFrame, name: str, ids: Sequence[str], sep: str = ".", key: str = "key", value: str = "value"
) -> DataFrame:
    """One row per list element, keyed ``name.index``; nulls inside the list are kept."""
    found = find(df.schema, name, sep)
    if found is None or not isinstance(found[1], T.ArrayType):
        raise ValueError(f"{name!r} is not a list field")
    items = df.select(*[column((i,)) for i in ids], F.posexplode(column(found[0])).alias("_pos", value))
    return items.select(
        *ids, F.concat(F.lit(name + sep), F.col("_pos").cast("string")).alias(key), F.col(value)
    )


def flat_view(df: DataFrame, sep: str = ".", max_array: int | None = None) -> dict[str, Column]:
    """Flattened attributes of a metric frame, without the metric itself."""
    return flat_columns(frame.attribute_schema(df), sep, max_array, (frame.ATTRIBUTES,))


def nested(name: str, sep: str = ".") -> Column:
    """Column for a dotted path whose parts contain no separator."""
    return F.col(quoted(tuple(name.split(sep))))


def merged(left: Mapping[str, Column], right: Mapping[str, Column]) -> Column:
    """Struct of both mappings, the right side winning on equal names."""
    return F.struct(*[c.alias(n) for n, c in (dict(left) | dict(right)).items()])
