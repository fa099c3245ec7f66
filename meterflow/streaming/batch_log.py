"""A log of batches with a snapshot of the older ones, so that reads do not grow with the number of batches.

Below the log's folder ``batches/<id>`` holds the rows of each batch, ``snapshots/<name>`` the merged rows of all batches
up to one of them, and ``manifests/<version>.json`` names the snapshot that is valid. A reader takes the newest manifest, its
snapshot and the later batches. Manifests are published by a rename, and nothing a reader of the manifest before needs
is removed, so a compaction that fails midway, or runs beside a reader, changes no result.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from meterflow.streaming.store import Store

Merge = Callable[[DataFrame], DataFrame]


class BatchLog:
    """Batches with ascending ids, written by one stream; ``merge`` folds rows of several batches to rows of one schema.

    ``merge(merge(a) + b)`` must equal ``merge(a + b)``. A batch that is repeated replaces what it wrote. The newest batch
    is never compacted, as it is the one a stream may repeat; an older one that comes again is already part of the
    snapshot and is left out.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType | str, merge: Merge, every: int = 16):
        if every < 1:
            raise ValueError("a log is compacted after at least one batch")
        self.spark, self.folder, self.merge, self.every = spark, folder.rstrip("/"), merge, every
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        self.store = Store(spark, self.folder)

    def manifest(self) -> dict:
        """The newest manifest: ``version``, ``snapshot`` (none at first) and the last batch it covers."""
        versions = [int(n[:-5]) for n in self.store.names("manifests") if n[:-5].isdigit() and n.endswith(".json")]
        if not versions:
            return {"version": 0, "snapshot": None, "upto": -1, "before": None}
        return {"version": max(versions), **json.loads(self.store.read(f"manifests/{max(versions):012d}.json"))}

    def _batches(self, after: int) -> list[int]:
        """Batches that were written to their end."""
        ids = sorted(int(n) for n in self.store.names("batches") if n.isdigit() and int(n) > after)
        return [i for i in ids if self.store.exists(f"batches/{i}/_SUCCESS")]

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Write one batch, then compact the older ones if there are many."""
        known = self.manifest()
        if batch_id <= known["upto"]:
            return
        rows.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.folder}/batches/{batch_id}")
        if len([i for i in self._batches(known["upto"]) if i < batch_id]) >= self.every:
            self.compact(batch_id - 1)

    def compact(self, upto: int) -> None:
        """A new snapshot of all batches up to ``upto``, published by the next manifest."""
        known = self.manifest()
        batches = [i for i in self._batches(known["upto"]) if i <= upto]
        if not batches:
            return
        name = f"{upto}-{uuid.uuid4().hex}"
        merged = self.merge(self._read(known["snapshot"], batches))
        merged.select(*self.schema.names).write.parquet(f"{self.folder}/snapshots/{name}")
        entry = {"snapshot": name, "upto": upto, "before": known["snapshot"]}
        self.store.publish(f"manifests/{known['version'] + 1:012d}.json", json.dumps(entry))
        self._sweep(known, name)

    def _sweep(self, known: dict, name: str) -> None:
        """Remove what neither this manifest nor the one before needs."""
        for i in self.store.names("batches"):
            if i.isdigit() and int(i) <= known["upto"]:
                self.store.remove(f"batches/{i}")
        for other in self.store.names("snapshots"):
            if other not in (name, known["snapshot"]):
                self.store.remove(f"snapshots/{other}")
        for file in self.store.names("manifests"):
            if file[:-5].isdigit() and int(file[:-5]) < known["version"]:
                self.store.remove(f"manifests/{file}")

    def _paths(self, snapshot: str | None, batches: list[int]) -> list[str]:
        return [*([f"snapshots/{snapshot}"] if snapshot else []), *(f"batches/{i}" for i in batches)]

    def _read(self, snapshot: str | None, batches: list[int]) -> DataFrame:
        paths = [f"{self.folder}/{p}" for p in self._paths(snapshot, batches)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def rows(self) -> DataFrame:
        """Rows of the snapshot and the batches after it, not yet merged."""
        known = self.manifest()
        return self._read(known["snapshot"], self._batches(known["upto"]))

    def read(self) -> DataFrame:
        """All batches as if they were one."""
        return self.merge(self.rows())

    def folders(self) -> list[str]:
        """What ``rows`` reads: at most one snapshot and ``every`` batches and the newest."""
        known = self.manifest()
        return self._paths(known["snapshot"], self._batches(known["upto"]))


def log_batches(stream: DataFrame, log: BatchLog, fold: Merge, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append ``fold`` of every micro-batch to the log; rows may come in any order and however late."""
    def write(batch: DataFrame, batch_id: int) -> None:
        log.append(fold(batch), batch_id)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
