"""Token-id matrices: best-fit-decreasing packing with a segment tree.

Documents are dealt into shards by a hash of their values; a shard streams
through one task.  Its documents become token ids with an end id, split into
pieces of at most ``width`` ids (nothing is lost: the pieces of a document in
order are its ids), and every ``BUFFER`` ids are packed best-fit decreasing: a
segment tree over the free room of the open rows finds the fullest row that still
takes a piece in logarithmic time.  The rows are written as matrices of
little-endian ids, with the cumulative lengths of the segments and the places
where positions start again at 0.

A shard holds one buffer at a time, so a hot key costs time in its shard, not
memory; and no token is shuffled, only the texts once.  The matrices are the
rows of a Parquet table, so Spark's commit protocol makes the output of a lost or
repeated task count once.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from basketry.llm.common import small
from basketry.llm.tokens import byte_tokenizer

WIDTH = 2048
BUFFER = 1 << 21                # ids packed at a time
MATRIX_ROWS = 128
SHARD_BYTES = 8 << 20
SCHEMA = ("shard bigint, matrix int, n_rows int, width int, id_bytes int, ids binary, cu_seqlens array<int>, "
          "resets array<int>, segments array<struct<{key}, piece:int, start:bigint, length:int, row:int, offset:int>>")


class RoomTree:
    """Open rows by their free room: a segment tree over rooms 0 to ``width``
    that knows for every range whether it holds a row."""

    def __init__(self, width: int):
        self.leaves = 1 << width.bit_length()
        self.filled = [0] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def _count(self, room: int, by: int) -> None:
        at = self.leaves + room
        while at:
            self.filled[at] += by
            at >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows.setdefault(room, []).append(row)
        self._count(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """The row with the smallest room of at least ``least``: up from the
        leaf to the first right-hand range with a row, then down its left side."""
        at = self.leaves + least
        if not self.filled[at]:
            while at > 1 and (at & 1 or not self.filled[at + 1]):
                at >>= 1
            if at == 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.filled[2 * at] else 2 * at + 1
        room = at - self.leaves
        self._count(room, -1)
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Row and offset of each piece, and the number of rows.  Equal lengths keep
    their order."""
    tree, rows = RoomTree(width), 0
    row, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = tree.take(n)
        if found is None:
            found, rows = (width, rows), rows + 1
        row[i], offset[i] = found[1], width - found[0]
        if found[0] > n:
            tree.put(found[0] - n, found[1])
    return row, offset, rows


def token_matrices(docs: DataFrame, tokenizer_path: str, pattern: str, key: str = "doc_id", text: str = "text",
                   end_id: int = 50_256, width: int = WIDTH, matrix_rows: int = MATRIX_ROWS,
                   shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per matrix: ``shard``, ``matrix`` (its number in the shard),
    ``n_rows``, ``width``, ``id_bytes`` (2 or 4), ``ids`` (n_rows x width, row by
    row, padded with the end id), ``cu_seqlens`` (cumulative segment lengths
    over the flattened matrix from 0 on; padding is a segment of its own),
    ``resets`` (where positions start again: the segments' first places) and
    ``segments`` (key, piece, start in the document's ids, length, row, offset).

    Defined results: a null or empty text is the end id alone; repeated rows and
    null keys are packed one by one; an empty table gives an empty result;
    columns other than key and text are not read.  The shard of a document
    depends on its key and text only, so reruns agree."""
    size = docs.agg(F.sum(F.octet_length(F.col(text)).cast("double"))).first()[0] or 0.0
    shards = max(1, int(-(-size // shard_bytes)))
    rows = docs.select(F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(shards)).alias("shard"),
                       F.col(key).alias("k"), F.col(text).alias("t"))
    rows = rows.repartition(F.col("shard")).sortWithinPartitions("shard", "k", "t")
    kind = docs.schema[key].dataType

    def run(batches):
        coder = byte_tokenizer(tokenizer_path, pattern)
        wide = 2 if coder.kind == "H" and end_id < 65_536 else 4
        dtype = np.dtype(f"<u{wide}")
        end = np.array([end_id], dtype).tobytes()
        shard, number, waiting, held = None, 0, [], 0

        def flush():
            nonlocal number, waiting, held
            lengths = np.array([len(w[3]) // wide for w in waiting], np.int64)
            row, offset, n_rows = best_fit_decreasing(lengths, width)
            order = np.lexsort((offset, row))
            cuts = np.searchsorted(row[order], np.arange(0, n_rows + matrix_rows, matrix_rows))
            for m in range(len(cuts) - 1):
                some = order[cuts[m]:cuts[m + 1]].tolist()
                if not some:
                    continue
                first = m * matrix_rows
                height = min(n_rows, first + matrix_rows) - first
                flat = bytearray(np.full(height * width, end_id, dtype).tobytes())
                marks, segments = [], []
                for i in some:
                    k, piece, start, ids = waiting[i]
                    at = (int(row[i]) - first) * width + int(offset[i])
                    flat[wide * at:wide * at + len(ids)] = ids
                    marks += (at, at + len(ids) // wide)
                    segments.append({"key": k, "piece": piece, "start": start, "length": len(ids) // wide,
                                     "row": int(row[i]) - first, "offset": int(offset[i])})
                seqlens = sorted({0, height * width, *marks})
                yield pa.RecordBatch.from_pylist(
                    [{"shard": shard, "matrix": number, "n_rows": height, "width": width, "id_bytes": wide,
                      "ids": bytes(flat), "cu_seqlens": seqlens, "resets": seqlens[:-1], "segments": segments}],
                    schema=arrow)
                number += 1
            waiting, held = [], 0

        for batch in small(batches):
            for s, k, t in zip(*(c.to_pylist() for c in batch.columns)):
                if s != shard:
                    yield from flush()
                    shard, number = s, 0
                ids = coder.encode(t)
                if coder.kind == "H" and wide == 4:
                    ids = np.frombuffer(ids, "<u2").astype(dtype).tobytes()
                ids += end
                for piece, at in enumerate(range(0, len(ids), wide * width)):
                    waiting.append((k, piece, at // wide, ids[at:at + wide * width]))
                    held += len(waiting[-1][3]) // wide
                    if held >= BUFFER:
                        yield from flush()
        yield from flush()

    schema = T.StructType.fromDDL(SCHEMA.format(key=f"key:{kind.simpleString()}"))
    arrow = to_arrow_schema(schema)
    return rows.mapInArrow(run, schema)


def position_ids(n_rows: int, width: int, resets: list[int]) -> np.ndarray:
    """The positions of a matrix: 0, 1, 2, ... from each reset on."""
    flat = np.arange(n_rows * width)
    starts = np.array(resets, np.int64)
    return (flat - starts[np.searchsorted(starts, flat, "right") - 1]).reshape(n_rows, width)


def segment_rows(matrices: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per segment read back from the matrices: where it lies, and the
    crc32 of its ids there (as little-endian 32-bit ids).

    Defined results: a null key stays null; segments of repeated rows are rows of
    their own; an empty table gives an empty result."""
    kind = matrices.schema["segments"].dataType.elementType["key"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for m in batch.to_pylist():
                flat = np.frombuffer(m["ids"], f"<u{m['id_bytes']}").astype("<u4")
                out = []
                for s in m["segments"]:
                    at = s["row"] * m["width"] + s["offset"]
                    out.append({"key": s["key"], "piece": s["piece"], "start": s["start"], "length": s["length"],
                                "ids_crc32": zlib.crc32(flat[at:at + s["length"]].tobytes()), "shard": m["shard"],
                                "matrix": m["matrix"], "row": s["row"], "offset": s["offset"],
                                "cu_start": at, "cu_end": at + s["length"]})
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    schema = T.StructType.fromDDL(f"key {kind}, piece int, start bigint, length int, ids_crc32 bigint, shard bigint, "
                                  "matrix int, row int, offset int, cu_start int, cu_end int")
    arrow = to_arrow_schema(schema)
    return matrices.mapInArrow(run, schema).withColumnRenamed("key", key)
