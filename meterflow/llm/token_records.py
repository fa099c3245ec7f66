"""Token ids as length-delimited binary records with masked checksums, and an offset index beside them.

A file is a run of frames: the payload's length (8 bytes), the masked CRC-32C of these bytes (4), the payload, and its
masked CRC-32C (4), all little-endian. A payload is a head of 16 bytes (document id, flags, number of ids) and the ids in
2 or 4 bytes each. Every file ends with one empty frame, so a cut-off file is noticed.

Files are written by Spark's text sink, one blob a file, whose line end is the empty frame: any store Spark can write to
works, and the commit protocol keeps a repeated task's files from appearing twice. ``records`` holds the files,
``index`` one row for each record (file, offset, length, first token), ``files`` one row for each file.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterflow.llm.shared import _offsets, _power, mixed, pieces, shared_dir, sized, stored

# fixed values: the polynomial of CRC-32C (reflected), the constant of the mask
CASTAGNOLI = 0x82F63B78
MASK_DELTA = 0xA282EAD8

#: Bytes of frames from which a file is closed; a longer record is a file of its own.
FILE_BYTES = 8 << 20
#: Bytes whose checksum is taken at once.
BLOCK = 1024
#: Different pieces of text whose ids a worker remembers; then it starts anew.
REMEMBERED = 1_000_000
#: Longest piece that is remembered.
PIECE = 64

#: Head of a payload: document id, flags, number of ids.
HEAD, HEAD_BYTES = "<qII", 16
NO_ID, WIDE = 1, 2

#: Bytes of white space, of ASCII letters and digits, and of other visible ASCII characters.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 1
_CLASS[33:127] = 3
for _range in (range(48, 58), range(65, 91), range(97, 123)):
    _CLASS[_range] = 2
_WEIGHT = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)

#: Texts with other white space or invisible characters are only cut after a character that surely is visible.
UNUSUAL = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f-\u2064\u3000\ufeff]")
CUT = re.compile(r"(?<=[!-~\w])(?=[\t\n\r ])")


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin that can be encoded alone, as a token starts there whatever comes before.

    That is at white space after another character, and at ASCII punctuation after an ASCII letter or digit.
    """
    kind = _CLASS[data]
    first = np.zeros(len(data), bool)
    first[1:] = ((kind[1:] == 1) & (kind[:-1] != 1)) | ((kind[1:] == 3) & (kind[:-1] == 2))
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(first)


class Crc32c:
    """CRC-32C of byte arrays: table ``steps[d]`` gives each byte's share when d bytes follow it, shares are combined by xor."""

    def __init__(self) -> None:
        row = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            row = np.where(row & 1, (row >> 1) ^ np.uint32(CASTAGNOLI), row >> 1).astype(np.uint32)
        steps = np.empty((BLOCK + 4, 256), np.uint32)
        steps[0] = row
        for d in range(1, len(steps)):
            steps[d] = (steps[d - 1] >> 8) ^ row[steps[d - 1] & 0xFF]
        self.steps, self.short = steps, steps[:8].tolist()
        # the register moved past one block: its byte k is followed by the block less the bytes before it
        self.past = [steps[BLOCK - 1 - k].tolist() for k in range(4)]

    def _eight(self, data: bytes) -> int:
        a, b, c, d, e, f, g, h = data
        s = self.short
        return s[7][a ^ 255] ^ s[6][b ^ 255] ^ s[5][c ^ 255] ^ s[4][d ^ 255] ^ s[3][e] ^ s[2][f] ^ s[1][g] ^ s[0][h] ^ 0xFFFFFFFF

    def _share(self, data: np.ndarray) -> np.ndarray:
        """Of equally long rows of at most a block."""
        n = data.shape[-1]
        return np.bitwise_xor.reduce(self.steps[np.arange(n - 1, -1, -1), data], axis=-1) if n else np.zeros(data.shape[:-1], np.uint32)

    def __call__(self, data: bytes) -> int:
        if len(data) == 8:
            return self._eight(data)
        raw = np.frombuffer(data, np.uint8)
        # the register starts with ones: as if the first four bytes were inverted
        raw = np.concatenate([raw[:4] ^ np.uint8(255), raw[4:]])
        if len(raw) < 4:
            state = int(self._share(raw)) ^ (0xFFFFFFFF >> 8 * len(raw))
            return state ^ 0xFFFFFFFF
        first = len(raw) % BLOCK
        state = int(self._share(raw[:first]))
        for share in self._share(raw[first:].reshape(-1, BLOCK)).tolist() if len(raw) > first else ():
            a, b, c, d = self.past
            state = a[state & 255] ^ b[state >> 8 & 255] ^ c[state >> 16 & 255] ^ d[state >> 24] ^ share
        return state ^ 0xFFFFFFFF


def masked(crc: int) -> int:
    """A checksum rotated and shifted, so that data which holds checksums is not checked by itself."""
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes, crc: Crc32c) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join([length, struct.pack("<I", masked(crc(length))), payload, struct.pack("<I", masked(crc(payload)))])


def frames(data: bytes | pa.Buffer, crc: Crc32c | None) -> Iterator[tuple[int, memoryview]]:
    """``offset, payload`` of each record of a file; ``crc`` also checks the payloads. A broken file is an error."""
    view, at, check = memoryview(data), 0, crc or _checksum()
    while True:
        if at + 16 > len(view):
            raise ValueError(f"the file ends within a frame at {at}")
        n, mark = struct.unpack_from("<QI", view, at)
        if masked(check(bytes(view[at:at + 8]))) != mark or at + 16 + n > len(view):
            raise ValueError(f"broken length at {at}")
        payload = view[at + 12:at + 12 + n]
        if crc and masked(crc(payload)) != struct.unpack_from("<I", view, at + 12 + n)[0]:
            raise ValueError(f"broken record at {at}")
        at += 16 + n
        if not n:
            break
        yield at - 16 - n, payload
    if at != len(view):
        raise ValueError(f"bytes after the last frame at {at}")


_made: dict[str, object] = {}


def _checksum() -> Crc32c:
    if "crc" not in _made:
        _made["crc"] = Crc32c()
    return _made["crc"]


def _encoder(tokenizer: str) -> Encoder:
    """The worker's encoder: what one task learned serves the next."""
    if _made.get("tokenizer") != tokenizer:
        _made.update(tokenizer=tokenizer, encoder=Encoder(tokenizer))
    return _made["encoder"]


def packed(doc_id: int | None, ids: np.ndarray) -> bytes:
    """The payload of a record; ids below 65536 take two bytes each."""
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    flags = (NO_ID if doc_id is None else 0) | (WIDE if wide else 0)
    return struct.pack(HEAD, doc_id or 0, flags, len(ids)) + ids.astype("<u4" if wide else "<u2").tobytes()


def unpacked(payload: memoryview | bytes) -> tuple[int | None, np.ndarray]:
    doc_id, flags, n = struct.unpack_from(HEAD, payload, 0)
    ids = np.frombuffer(payload, "<u4" if flags & WIDE else "<u2", offset=HEAD_BYTES)
    if len(ids) != n:
        raise ValueError("a record's number of ids is wrong")
    return (None if flags & NO_ID else doc_id), ids.astype("<u4")


class Encoder(dict):
    """Ids of pieces of text, both as bytes; new pieces are encoded some hundreds at a time."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_str(tokenizer)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        vocabulary = self.library.get_vocab()
        # a character of a byte-level token is one byte
        self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.sizes[list(vocabulary.values())] = [len(t) for t in vocabulary]

    def __missing__(self, piece: bytes) -> bytes:
        ids = array("I", self.library.encode(piece.decode(), add_special_tokens=False).ids).tobytes()
        if len(piece) <= PIECE:
            self[piece] = ids
        return ids

    def _meet(self, new: list[bytes]) -> None:
        """Encodes new pieces in one text: each starts with white space and ends with a visible character."""
        for k in range(0, len(new), 500):
            part = new[k:k + 500]
            ids = np.array(self.library.encode(b"".join(part).decode(), add_special_tokens=False).ids, "<u4")
            ends = np.cumsum(self.sizes[ids])
            cuts = np.searchsorted(ends, np.cumsum([len(p) for p in part])) + 1
            raw, at = ids.tobytes(), 0
            for p, cut in zip(part, (4 * cuts).tolist(), strict=True):
                self[p] = raw[at:cut]
                at = cut

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each whole text."""
        if len(self) >= REMEMBERED:
            self.clear()
        plain = texts.to_pylist()
        offsets = _offsets(texts)
        raw = texts.buffers()[2].slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes() if offsets[-1] > offsets[0] else b""
        offsets = offsets - offsets[0]
        data = np.frombuffer(raw, np.uint8)
        starts = piece_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        p, q = _power(len(data) + 1)
        hashes = mixed(np.add.reduceat(_WEIGHT[data] * p[:len(data)], starts) * q[starts]) if len(starts) else np.zeros(0, np.uint64)
        # equal pieces of these texts once, then by their bytes
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        distinct = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        self._meet([d for d in distinct if d not in self and len(d) <= PIECE and d[0] in b" \n" and (
            d[-1:].isalnum() or d[-1] > 127 and not UNUSUAL.search(d.decode()))])
        known = [self[d] for d in distinct]
        sizes = np.array([len(k) for k in known], np.int64) // 4
        flat = np.frombuffer(b"".join(known), "<u4")
        lengths = sizes[which]
        total = np.concatenate([[0], np.cumsum(lengths)])
        out = flat[np.repeat((np.cumsum(sizes) - sizes)[which] - total[:-1], lengths) + np.arange(total[-1])]
        cuts = total[np.searchsorted(starts, offsets)]
        found = [out[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        for k, text in enumerate(plain):
            special = any(s in text for s in self.special)
            if special or UNUSUAL.search(text):
                parts = [text] if special else CUT.split(text)
                found[k] = np.frombuffer(b"".join([self[x.encode()] for x in parts]) if text else b"", "<u4")
        return found


def _cuttable(tokenizer: str) -> bool:
    """Byte-level pre-tokenizing by its usual pattern, without a normaliser or added prefix: what ``CUT`` relies on."""
    spec = json.loads(tokenizer)
    pre = spec.get("pre_tokenizer") or {}
    return pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer")


def write_records(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 2, id_column: str = "doc_id", text: str = "text",
    file_bytes: int = FILE_BYTES,
) -> None:
    """Writes every text's ids and ``end_id`` in ascending order of the id, null ids last, below ``folder``.

    Files in name order hold the records in order. A null or empty text is the end id alone; rows that repeat an id are
    records of their own, ordered by a hash of the text. A text's bytes pass one shuffle by ranges of (id, hash, input
    partition), so that an id of many rows is dealt to several ranges. An empty table gives no files and empty indexes.
    """
    spark = docs.sparkSession
    shared_dir(spark)
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = file.read()
    if not _cuttable(spec):
        raise ValueError("the tokenizer must be byte-level with its usual pattern, without normaliser and prefix")
    # the file has a few MB whatever the corpus is
    shipped = spark.sparkContext.broadcast(spec)
    order = [F.asc_nulls_last("_id"), F.asc("_hash"), F.asc("_part")]
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    rows = rows.withColumns({"_hash": F.xxhash64("_text"), "_part": F.spark_partition_id()})
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("_id", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, crc = _encoder(shipped.value), _checksum()
        end = np.array([end_id], "<u4")
        blob: list[bytes] = []
        size = 0
        for batch in batches:
            for part in pieces(batch, "_text", 2 << 20):
                found = encoder.ids(part.column(1))
                for doc_id, ids in zip(part.column(0).to_pylist(), found, strict=True):
                    record = frame(packed(doc_id, np.concatenate([ids, end])), crc)
                    blob.append(record)
                    size += len(record)
                    if size >= file_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array([b"".join(blob)], pa.binary())], ["blob"])
                        blob, size = [], 0
        if blob:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(blob)], pa.binary())], ["blob"])

    last = frame(b"", _checksum()).decode("latin-1")
    rows.mapInArrow(run, "blob binary").select(F.col("blob").cast("string").alias("value")).write.option(
        "maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", last).text(f"{folder}/records")
    _write_index(spark, folder)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """``file, content`` of every file; the names of Spark's part files are in the records' order."""
    return spark.read.format("binaryFile").load(f"{folder}/records").where("length > 0").select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def _write_index(spark: SparkSession, folder: str) -> None:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1), strict=True):
                found = [(at, len(p), *struct.unpack_from(HEAD, p, 0)) for at, p in frames(data.as_buffer(), None)]
                at, length, doc, flags, n = (np.array(c, np.int64) for c in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([
                    pa.array([name.as_py()] * len(at)), pa.array(at), pa.array(length),
                    pa.array(doc, mask=(flags & NO_ID) > 0), pa.array(n), pa.array(np.cumsum(n) - n),
                ], ["file", "offset", "length", "doc_id", "n_tokens", "before"])

    rows = stored(_files(spark, folder).mapInArrow(
        run, "file string, offset bigint, length bigint, doc_id bigint, n_tokens bigint, before bigint"), "index")
    part, number = (F.regexp_extract("file", p, 1).cast("long") for p in (r"^part-(\d+)-", r"-c(\d+)\."))
    files = stored(rows.groupBy("file").agg(F.count("*").alias("records"), F.sum("n_tokens").alias("tokens")).select(
        "file", part.alias("part"), number.alias("number"), "records", "tokens"), "files")
    # one row for each task that wrote: bounded by the number of partitions
    sums = sorted(tuple(r) for r in files.groupBy("part").agg(F.sum("tokens")).collect())
    starts, total = [], 0
    for p, n in sums:
        starts.append((p, total))
        total += n
    starts = F.broadcast(spark.createDataFrame(starts, "part bigint, _start bigint"))
    earlier = F.sum("tokens").over(Window.partitionBy("part").orderBy("number")) - F.col("tokens")
    files = files.withColumn("_earlier", earlier).join(starts, "part").select(
        "file", "part", "number", "records", "tokens", (F.col("_start") + F.col("_earlier")).alias("start"))
    files.write.parquet(f"{folder}/files")
    first = sized(spark.read.schema(files.schema).parquet(f"{folder}/files").select(F.col("file").alias("_file"), F.col("start").alias("_start")))
    rows.join(first, F.col("file") == F.col("_file")).select(
        "file", "offset", "length", "doc_id", "n_tokens", (F.col("_start") + F.col("before")).alias("start"),
    ).write.parquet(f"{folder}/index")


FILES = "file string, part bigint, number bigint, records bigint, tokens bigint, start bigint"
INDEX = "file string, offset bigint, length bigint, doc_id bigint, n_tokens bigint, start bigint"


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read_records(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and with ``ids`` the ids themselves, of every record, all checksums verified."""
    first = sized(spark.read.schema(FILES).parquet(f"{folder}/files").select(F.col("file").alias("_file"), F.col("start").alias("_start")))
    rows = _files(spark, folder).join(first, F.col("file") == F.col("_file")).select("_start", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc = _checksum()
        for batch in batches:
            for start, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                chunk: list[tuple] = []
                held = 0
                for _, payload in frames(data.as_buffer(), crc):
                    doc_id, values = unpacked(payload)
                    chunk.append((doc_id, start, len(values), zlib.crc32(values), values if ids else None))
                    start, held = start + len(values), held + len(values)
                    if held >= 1 << 19:
                        yield _batch(chunk, ids)
                        chunk, held = [], 0
                if chunk:
                    yield _batch(chunk, ids)

    return rows.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if ids else ""))


def _batch(rows: list[tuple], ids: bool) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    columns = [*zip(*rows, strict=True)]
    arrays = [pa.array(c, pa.int64()) for c in columns[:4]]
    if ids:
        cuts = np.concatenate([[0], np.cumsum([len(v) for v in columns[4]])]).astype(np.int32)
        arrays.append(pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(columns[4]).astype(np.int64))))
        names.append("ids")
    return pa.RecordBatch.from_arrays(arrays, names)


def shuffled(spark: SparkSession, folder: str, seed: int, chosen: DataFrame | None = None) -> DataFrame:
    """``doc_id, ids`` in an order drawn from the seed, sliced from the files by the offset index.

    ``chosen`` are rows of the index (all by default): a file without any of them is read and left. The order is that of
    a hash of seed, file and offset, by ranges, so equal seeds agree whatever the cluster is. A file's entries come
    together, bounded by its size.
    """
    shared_dir(spark)
    index = read_index(spark, folder) if chosen is None else chosen
    wanted = index.groupBy(F.col("file").alias("_file")).agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("_at"))
    rows = _files(spark, folder).join(wanted, F.col("file") == F.col("_file")).select("file", "_at", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc = _checksum()
        for batch in batches:
            for name, entries, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                view = memoryview(data.as_buffer())
                for e in entries:
                    at, n = e["offset"], e["length"]
                    payload = view[at + 12:at + 12 + n]
                    if masked(crc(payload)) != struct.unpack_from("<I", view, at + 12 + n)[0]:
                        raise ValueError(f"broken record at {at} of {name}")
                    doc_id, values = unpacked(payload)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name]), pa.array([at], pa.int64()), pa.array([doc_id], pa.int64()),
                        pa.array([values.astype(np.int64)], pa.list_(pa.int64()))], ["file", "offset", "doc_id", "ids"])

    drawn = F.xxhash64(F.lit(seed), F.regexp_extract("file", r"^part-(\d+)-", 1), F.regexp_extract("file", r"-c(\d+)\.", 1), "offset")
    found = rows.mapInArrow(run, "file string, offset bigint, doc_id bigint, ids array<bigint>").withColumn("_draw", drawn)
    return found.repartitionByRange("_draw").sortWithinPartitions("_draw", "file", "offset").select("doc_id", "ids")
