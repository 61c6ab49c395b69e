"""How filters overlap, whatever the order they are applied in.

Every document has a mask of the filters that it fails.  For all orders of the filters at once, the step
that removes a document is the min-plus product of two matrices: masks (0 where the filter fails, else
infinity) and places (the inverse permutation: at which step an order applies the filter), combined by minimum
over the filters.  The steps then scatter the documents' counts: how many go at each step, were gone before
(redundant), fail nothing else, or were good or toxic.

Documents are judged once and counted by (part, mask); a part then has at most 2 to the number of
filters rows, however many documents.  The matrices work on these counts, one part at a time, in the tasks.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import lookup, slices, written

#: Filters, in the order of their bits.
FILTERS = "ABCDE"
_SYMBOLS = frozenset("#$%&*|")
_NOT_UPPER = bytes(b for b in range(256) if not 0x41 <= b <= 0x5A)
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failed(text: str) -> int:
    """Bits of the filters A to D that one text fails."""
    data = text.encode()
    words = data.split()  # at the six white-space characters of ASCII
    distinct = len(set(words))
    return ((len(words) < 200) | (100 * distinct < 50 * len(words)) << 1
            | (100 * len(data.translate(None, _NOT_UPPER)) > 2 * len(text)) << 2 | (not _SYMBOLS.isdisjoint(text)) << 3)


_JUDGED = pa.struct([("mask", pa.int32()), ("digest", pa.binary())])


def judged(text: Column) -> Column:
    """Struct of the mask of A to D and a digest of 128 bits of each text; null counts as empty."""

    @arrow_udf("struct<mask:int,digest:binary>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([(failed(x or ""), xxhash.xxh3_128_digest((x or "").encode())) for part in slices(batch) for x in part], _JUDGED)

    return of.asNondeterministic()(text)


def places(orders: list[str]) -> np.ndarray:
    """Step (from 0) at which each order applies each filter: orders x filters, the inverse permutations."""
    return np.array([[order.index(f) for f in FILTERS] for order in orders])


def removal_steps(masks: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Masks x orders: the step that removes a mask's documents, or the number of filters if none does.

    ``masks``: masks x filters, whether the filter fails; ``steps``: see ``places``.
    """
    never = len(FILTERS)
    return np.where(masks[:, None, :], steps[None, :, :], never).min(axis=2)


def audit_counts(masks: np.ndarray, weights: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Orders x steps x measures (see MEASURES), from the documents of one part.

    ``masks``: masks x filters; ``weights``: masks x (documents, good, toxic).
    """
    n_masks, n_orders, n = len(masks), len(steps), len(FILTERS)
    gone = removal_steps(masks, steps)
    # scatter: the weights of each mask go to its step in each order; the last column holds what stays
    cell = (np.arange(n_orders) * (n + 1) + gone).ravel()
    lost = np.stack([np.bincount(cell, np.repeat(w, n_orders), n_orders * (n + 1)) for w in weights.T.astype(float)], axis=1)
    lost = lost.reshape(n_orders, n + 1, 3)[:, :n].round().astype(np.int64)
    total = weights[:, 0].sum()
    filter_at = np.argsort(steps, axis=1)  # orders x steps
    rows = np.arange(n_orders)[:, None]
    # of a filter's failures, those of masks removed at an earlier step
    early = (masks[:, None, :] & (gone[:, :, None] < steps[None, :, :])) * weights[:, 0][:, None, None]
    only = ((masks.sum(axis=1) == 1)[:, None] & masks).T @ weights[:, 0]
    removed = lost[:, :, 0]
    shapley = np.zeros(n, np.int64)
    np.add.at(shapley, filter_at, removed)
    return np.stack([total - np.cumsum(removed, axis=1), removed, early.sum(axis=0)[rows, filter_at],
                     only[filter_at], lost[:, :, 1], lost[:, :, 2], shapley[filter_at]], axis=2)


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each part, filter order and step: part, filter_order, step and MEASURES.

    A document fails A with under 200 words, B if under half of them are distinct, C if over a fiftieth of the characters are
    A-Z, D if it holds one of ``#$%&*|``, E if a document of a smaller id has the same text, in whatever part.
    Null texts are empty (and equal each other), null parts are the empty part.  A null id is smaller than
    none and none is smaller: it never fails E and has no label.  Rows that repeat the id and text fail E alike.
    A document is good or toxic if one of its rows in ``labels`` (doc_id, quality, toxic) says so.  An empty table has no parts.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       judged(F.col(text_col).cast("string")).alias("j")).select("doc_id", "part", "j.mask", "j.digest")
    rows = written(rows, "filter-masks")
    copies = written(rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1"), "filter-copies")
    repeats = lookup(rows, copies, "digest", "n", "left")
    known = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                                         F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    is_copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    counted = (repeats.withColumn("mask", F.col("mask") + F.when(is_copy, 16).otherwise(0))
               .join(known, "doc_id", "left").groupBy("part", "mask")
               .agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")))
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    return parts.mapInArrow(_audited, "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES))


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each part; ``masks`` has at most 32 entries."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    steps, n = places(orders), len(FILTERS)
    order_column = pa.array([o for o in orders for _ in range(n)])
    step_column = pa.array(list(range(1, n + 1)) * len(orders), pa.int32())
    for batch in batches:
        for part, masks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            bits = np.array([[m["mask"] >> f & 1 for f in range(n)] for m in masks], bool)
            weights = np.array([[m["n"], m["good"], m["toxic"]] for m in masks], np.int64)
            found = audit_counts(bits, weights, steps).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(found), pa.string()), order_column, step_column,
                                              *map(pa.array, found.T.astype(np.int64))], ["part", "filter_order", "step", *MEASURES])
