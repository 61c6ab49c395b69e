"""Bounded-space online packing of documents into training sequences.

Every partition reads its documents once and keeps a fixed number of open windows.  What a
document has beyond full sequences goes into the open window that it fills best; when none has
room and no further window may be opened, the fullest one is emitted.  At the end the windows
still open are merged: the leftovers of ``MERGED`` partitions at a time, longest first into the
fullest sequence with room.  No step sees more than that many windows, whatever the input.
"""
from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import tokens
from .common import inputs, slices

#: Open windows of a partition; partitions whose leftovers are merged together.
OPEN, MERGED = 64, 8
END = b"\0\0\0\0"  # id 0 ends a document


class Windows:
    """Open windows of ``capacity`` tokens, best fit; ``place`` gives (window, offset)."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.opened = 0
        self.room: list[tuple[int, int]] = []  # (free tokens, window), least room first

    def fresh(self) -> int:
        self.opened += 1
        return self.opened - 1

    def place(self, length: int) -> tuple[int, int, int | None]:
        """Window and offset for ``length`` tokens, and the window emitted to make room, if any."""
        gone = None
        at = bisect_left(self.room, (length, -1))
        if at < len(self.room):
            free, window = self.room.pop(at)
        else:
            if len(self.room) == self.most:
                gone = self.room.pop(0)[1]
            free, window = self.capacity, self.fresh()
        if free > length:
            insort(self.room, (free - length, window))
        return window, self.capacity - free, gone


def _schema(with_ids: bool, *more: str) -> str:
    return ", ".join(["doc_id {id}", "start long", "length long", "ids_crc32 long", "doc_tokens long", *more,
                      "offset long"] + ["ids binary"] * with_ids)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, open_windows: int = OPEN,
         with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a byte-level BPE file of ``tokenizers``.  A document is its ids and then id 0, so an
    empty or null text has one token.  Full sequences are cut off its front; the rest, shorter than
    ``capacity``, is one piece.  ``with_ids`` adds the ids of each piece (binary, little-endian
    unsigned 32-bit).  Repeated rows are documents of their own; a null id stays null.  An empty
    table gives no piece.  A text may be of any length, one run of white space included.
    """
    rows = inputs(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, windows, part = tokens.byte_level(tokenizer), Windows(capacity, open_windows), TaskContext.get().partitionId()
        held: dict[int, list[tuple]] = {}  # pieces of the open windows
        done: list[tuple] = []

        def batch(pieces: list[tuple], is_open: bool) -> pa.RecordBatch:
            cols = list(zip(*pieces)) or [[]] * 8
            arrays = [pa.array(cols[0], ids_type), *(pa.array(c, pa.int64()) for c in cols[1:5]),
                      pa.array([part] * len(pieces), pa.int32()), pa.array(cols[5], pa.int64()),
                      pa.array([is_open] * len(pieces), pa.bool_()), pa.array(cols[6], pa.int64())]
            if with_ids:
                arrays.append(pa.array(cols[7], pa.binary()))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "win", "is_open", "offset"]
            return pa.RecordBatch.from_arrays(arrays, names + ["ids"] * with_ids)

        for b in batches:
            ids_type, at = b.column(0).type, 0
            names = b.column(0).to_pylist()
            for texts in slices(b.column(1)):
                for name, ids in zip(names[at:at + len(texts)], encoder.ids(texts)):
                    ids += END
                    total = len(ids) // 4
                    for start in range(0, total, capacity):
                        own = ids[4 * start:4 * (start + capacity)]
                        length = len(own) // 4
                        window, offset, gone = (windows.fresh(), 0, None) if length == capacity else windows.place(length)
                        piece = (name, start, length, zlib.crc32(own), total, window, offset, own if with_ids else None)
                        if gone is not None:
                            done += held.pop(gone)
                        if offset + length == capacity:
                            done += held.pop(window, [])
                            done.append(piece)
                        else:
                            held.setdefault(window, []).append(piece)
                at += len(texts)
                if len(done) > 4096:
                    yield batch(done, False)
                    done = []
        if done:
            yield batch(done, False)
        if held:
            yield batch([p for pieces in held.values() for p in pieces], True)

    placed = materialize(rows.mapInArrow(partition, _schema(with_ids, "part int", "win long", "is_open boolean").format(id=kind)))
    closed = placed.filter("not is_open").withColumn("sequence_id", F.shiftleft(F.col("part").cast("long"), 32) + F.col("win"))
    left = merge(placed.filter("is_open"), capacity)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    return closed.select(names).unionByName(left.select(names))


def merge(left: DataFrame, capacity: int, together: int = MERGED) -> DataFrame:
    """The pieces of windows still open, with their ``sequence_id`` and ``offset`` after merging.

    Windows of ``together`` partitions make a group: at most that many times the open windows.
    """
    sizes = (left.groupBy("part", "win").agg(F.sum("length").alias("n"))
             .withColumn("grp", F.floor(F.col("part") / together)))

    def into_sequences(table: pa.Table) -> pa.Table:
        n = table.column("n").to_numpy()
        part, win = table.column("part").to_numpy(), table.column("win").to_numpy()
        order = np.lexsort((win, part, -n))
        windows = Windows(capacity, len(n))
        placed = [windows.place(int(n[i]))[:2] for i in order]
        base = (2 ** 30 + table.column("grp")[0].as_py()) << 32  # beyond every partition's own
        return pa.table({"part": part[order], "win": win[order],
                         "sequence_id": pa.array([base + w for w, _ in placed], pa.int64()),
                         "shift": pa.array([o for _, o in placed], pa.int64())})

    moved = sizes.groupBy("grp").applyInArrow(into_sequences, "part int, win long, sequence_id long, shift long")
    return left.join(moved, ["part", "win"]).withColumn("offset", F.col("offset") + F.col("shift"))
