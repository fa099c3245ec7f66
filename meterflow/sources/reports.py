"""Wide reports to long metrics, and selection of paths by glob."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions.globs import matches_any, path_matches
from meterflow.functions.paths import column, quote
from meterflow.functions.values import widest

# Measures and attributes of a directory quota report.
QUOTA_MEASURES = (
    "maxbytes", "maxfiles", "maxlogicalbytes", "percentageusedbytes", "usedbytes", "usedfiles", "usedlogicalbytes",
)
QUOTA_ATTRIBUTES = ("gid", "quota", "space", "statusbytes", "statusfiles", "pattern")


def glob_filter(df: DataFrame, path: str, include: Sequence[str], skip: Sequence[str] = ()) -> DataFrame:
    """Rows whose path matches an include pattern and no skip pattern.

    Include patterns work per path segment like a directory listing; in skip patterns ``*`` also
    crosses segments.
    """
    value = column((path,))
    found = reduce(or_, [path_matches(value, p) for p in include], F.lit(False))
    return df.where(found & ~matches_any(value, skip)) if skip else df.where(found)


def unpivot_report(
    df: DataFrame,
    measures: Sequence[str] = QUOTA_MEASURES,
    attributes: Sequence[str] = QUOTA_ATTRIBUTES,
    key: str = "metric_key",
    path: str | None = None,
    patterns: Sequence[str] = (),
    skip: Sequence[str] = (),
) -> DataFrame:
    """One record per row and measure: ``metric``, the measure's name, and the attributes.

    With ``patterns`` only rows with a matching path are reported, once per pattern they match,
    and the attribute ``pattern`` names it. Null measures are kept.
    """
    if path is not None and patterns:
        df = glob_filter(df, path, patterns, skip)
        if "pattern" in attributes:
            hits = F.array(*[F.when(path_matches(column((path,)), p), F.lit(p)) for p in patterns])
            df = df.withColumn("pattern", F.explode(F.array_compact(hits)))
    ids = [a for a in attributes if a in df.columns]
    mtype = widest(df.schema[m].dataType for m in measures)
    wide = df.select(*[column((i,)) for i in ids], *[column((m,)).cast(mtype).alias(m) for m in measures])
    return wide.unpivot([quote(i) for i in ids], [quote(m) for m in measures], key, "metric")
