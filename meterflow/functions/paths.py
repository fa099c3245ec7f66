"""Dotted paths over a schema: leaves, columns and lookups, resolved when the plan is built."""

from __future__ import annotations

from pyspark.sql import Column, types as T
from pyspark.sql import functions as F

Path = tuple[str, ...]


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quoted(path: Path) -> str:
    return ".".join(quote(part) for part in path)


def column(path: Path) -> Column:
    return F.col(quoted(path))


def leaves(schema: T.StructType, prefix: Path = ()) -> list[tuple[Path, T.DataType]]:
    """Every non-struct field below ``schema`` in field order; empty structs have none."""
    found: list[tuple[Path, T.DataType]] = []
    for field in schema.fields:
        path = (*prefix, field.name)
        if isinstance(field.dataType, T.StructType):
            found += leaves(field.dataType, path)
        else:
            found.append((path, field.dataType))
    return found


def find(schema: T.StructType, dotted: str, sep: str = ".") -> tuple[Path, T.DataType] | None:
    """Path and type of a dotted name; field names may contain the separator themselves."""
    for field in schema.fields:
        if field.name == dotted:
            return (field.name,), field.dataType
    for field in schema.fields:
        head = field.name + sep
        if dotted.startswith(head) and isinstance(field.dataType, T.StructType):
            below = find(field.dataType, dotted[len(head):], sep)
            if below:
                return (field.name, *below[0]), below[1]
    return None


def without(schema: T.StructType, removed: set[Path], prefix: Path = ()) -> list[Column]:
    """Columns of ``schema`` minus the removed leaves; a struct left with no field goes as well."""
    kept = []
    for field in schema.fields:
        path = (*prefix, field.name)
        below = [p[len(path):] for p in removed if p[: len(path)] == path]
        if not below:
            kept.append(column(path).alias(field.name))
        elif () not in below:
            dropped = _drop(column(path), field.dataType, set(below))
            if dropped is not None:
                kept.append(dropped.alias(field.name))
    return kept


def _drop(struct: Column, schema: T.StructType, removed: set[Path]) -> Column | None:
    gone = []
    for field in schema.fields:
        below = {p[1:] for p in removed if p[0] == field.name}
        if () in below:
            gone.append(field.name)
        elif below:
            inner = _drop(struct.getField(field.name), field.dataType, below)
            if inner is None:
                gone.append(field.name)
            else:
                struct = struct.withField(quote(field.name), inner)
    if len(gone) == len(schema.fields):
        return None
    return struct.dropFields(*map(quote, gone)) if gone else struct
