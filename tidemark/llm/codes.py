"""Vector codes by product quantisation, with Lloyd rounds over cover trees.

Vectors are cut into equal parts, each with a codebook of its own. A task puts
the parts of a bounded block of vectors into cover trees (one per part): a
node's children are centres more than half its radius apart that cover all of
its points, and every node knows the sum and number of the points below it. A
Lloyd round walks the trees from the top. An entry that is further from a
node's centre than the nearest one by more than twice the node's radius is not
the nearest of any point below, so a node with one entry left gives its whole
subtree to it; only ambiguous nodes descend, down to exact comparisons in the
leaves. All distances are integers; square roots only serve the bounds.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sinks.tables import materialize

LEAF = 16  # points that a node need not part any more
SLOP = 1e-9  # relative rounding of the square roots, rounded up


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` and ``y``."""
    d = x[:, None, :] - y[None, :, :]
    return np.einsum("ijk,ijk->ij", d, d)


class CoverTree:
    """A cover tree over integer points; the points below a node are one range of ``order``."""

    def __init__(self, points: np.ndarray) -> None:
        n = len(points)
        order = np.arange(n)
        far = np.einsum("ij,ij->i", points - points[0], points - points[0])
        low, high, reach, child, children = [0], [n], [int(far.max())], [], []
        spread = [far]  # squared distances of a node's points to its centre, which is its first point
        node = 0
        while node < len(low):
            lo, hi, dist = low[node], high[node], spread[node]
            spread[node] = None
            child.append(len(low))
            if hi - lo <= LEAF or not reach[node]:
                children.append(0)
                node += 1
                continue
            left, at, made = order[lo:hi].copy(), lo, 0
            while len(left):
                if made:
                    d = points[left] - points[left[0]]
                    dist = np.einsum("ij,ij->i", d, d)
                near = 4 * dist <= reach[node]  # within half of the radius
                own, own_dist = left[near], dist[near]
                order[at:at + len(own)] = own
                low.append(at)
                high.append(at + len(own))
                reach.append(int(own_dist.max()))
                spread.append(own_dist)
                at += len(own)
                made += 1
                left, dist = left[~near], dist[~near]
            children.append(made)
            node += 1
        self.order = order
        self.low, self.high = np.array(low), np.array(high)
        self.radius = np.sqrt(np.array(reach, np.float64)) * (1 + SLOP)
        self.child, self.children = np.array(child), np.array(children)
        upto = np.concatenate((np.zeros((1, points.shape[1]), np.int64), np.cumsum(points[order], axis=0)))
        self.sums = upto[self.high] - upto[self.low]

    def assign(self, points: np.ndarray, entries: np.ndarray) -> Iterator[tuple[bool, np.ndarray, np.ndarray]]:
        """Nearest entries (the first of equals): ``(True, nodes, entries)`` of whole subtrees and
        ``(False, points, entries)`` of single points, which come to every point once."""
        nodes, open_ = np.zeros(1, np.int64), np.ones((1, len(entries)), bool)
        while len(nodes):
            exact = squares(points[self.order[self.low[nodes]]], entries)
            far = np.where(open_, np.sqrt(exact.astype(np.float64)), np.inf)
            least, radius = far.min(1, keepdims=True), self.radius[nodes, None]
            open_ &= far - least <= 2 * radius + SLOP * (far + least + radius + 1)
            done = (open_.sum(1) == 1) | (radius[:, 0] == 0)
            choice = np.where(open_, exact, np.iinfo(np.int64).max).argmin(1)
            if done.any():
                yield True, nodes[done], choice[done]
            leaf = ~done & (self.children[nodes] == 0)
            if leaf.any():
                size = (self.high - self.low)[nodes[leaf]]
                own = np.repeat(np.arange(len(size)), size)
                first = np.repeat(np.cumsum(size) - size, size)
                at = self.order[self.low[nodes[leaf]][own] + np.arange(len(own)) - first]
                d = np.where(open_[leaf][own], squares(points[at], entries), np.iinfo(np.int64).max)
                yield False, at, d.argmin(1)
            down = ~done & ~leaf
            size = self.children[nodes[down]]
            own = np.repeat(np.arange(len(size)), size)
            first = np.repeat(np.cumsum(size) - size, size)
            nodes, open_ = self.child[nodes[down]][own] + np.arange(len(own)) - first, open_[down][own]

    def tally(self, points: np.ndarray, entries: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
        """Adds the points nearest to each entry to ``sums`` and ``counts``."""
        for whole, at, choice in self.assign(points, entries):
            np.add.at(sums, choice, self.sums[at] if whole else points[at])
            np.add.at(counts, choice, self.high[at] - self.low[at] if whole else 1)

    def nearest(self, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """The nearest entry of every point."""
        found = np.empty(len(points), np.int64)
        for whole, at, choice in self.assign(points, entries):
            if whole:
                size = self.high[at] - self.low[at]
                first = np.repeat(np.cumsum(size) - size, size)
                at = self.order[np.repeat(self.low[at], size) + np.arange(size.sum()) - first]
                choice = np.repeat(choice, size)
            found[at] = choice
        return found


def _trees(batch: pa.RecordBatch, i: int) -> list[CoverTree]:
    found = []
    for arrays in pickle.loads(batch["trees"][i].as_py()):
        tree = CoverTree.__new__(CoverTree)
        vars(tree).update(arrays)
        found.append(tree)
    return found


def _points(batch: pa.RecordBatch, i: int, parts: int) -> list[np.ndarray]:
    """The parts of a block's vectors, as 64-bit integers."""
    raw = np.frombuffer(batch["points"][i].as_py(), np.int32).reshape(batch["size"][i].as_py(), -1)
    return [np.ascontiguousarray(p, np.int64) for p in np.split(raw, parts, axis=1)]


def blocks(rows: DataFrame, parts: int, block_rows: int) -> DataFrame:
    """Rows ``(vec_id, label, ints)`` as blocks of at most ``block_rows`` with a cover tree for each part, written once."""
    label = rows.schema["label"].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= block_rows:
                table = pa.Table.from_batches(held)
                yield block(table.slice(0, block_rows))
                held = table.slice(block_rows).to_batches()
        if sum(b.num_rows for b in held):
            yield block(pa.Table.from_batches(held))

    def block(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        ints = table["ints"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        own = [np.ascontiguousarray(p, np.int64) for p in np.split(ints.reshape(table.num_rows, -1), parts, axis=1)]
        trees = pickle.dumps([vars(CoverTree(p)) for p in own])  # arrays only
        ids, labels = (pa.ListArray.from_arrays(pa.array([0, table.num_rows], pa.int32()), table[c].combine_chunks())
                       for c in ("vec_id", "label"))
        return pa.RecordBatch.from_arrays(
            [pa.array([table.num_rows], pa.int32()), ids, labels, pa.array([ints.tobytes()], pa.binary()),
             pa.array([trees], pa.binary())], ["size", "vec_ids", "labels", "points", "trees"])

    return materialize(rows.select("vec_id", "label", "ints").mapInArrow(
        build, f"size int, vec_ids array<long>, labels array<{label}>, points binary, trees binary"), "codes")


def lloyd_round(held: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round; an entry without points stays. Each task sends one sum for each component."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros_like(b) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for i in range(batch.num_rows):
                for k, (tree, points) in enumerate(zip(_trees(batch, i), _points(batch, i, len(books)))):
                    tree.tally(points, books[k], sums[k], counts[k])
        part, entry, place = (x.ravel() for x in np.indices((len(books), *books[0].shape)))
        n = np.array(counts)[part, entry]
        columns = [part, entry, place, np.array(sums).ravel(), n]
        yield pa.RecordBatch.from_arrays([pa.array(x[n > 0], pa.int64()) for x in columns],
                                         ["part", "entry", "place", "total", "n"])

    found = (held.select("size", "points", "trees")
             .mapInArrow(tally, "part long, entry long, place long, total long, n long")
             .groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect())
    after = [b.copy() for b in books]
    for r in found:  # a row for each component of the codebooks
        after[r["part"]][r["entry"], r["place"]] = r["total"] // r["n"]
    return after


def compress(df: DataFrame, *, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 8,
             entries: int = 16, rounds: int = 6, scale: int = 4096, block_rows: int = 4096) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes of all vectors and the codebooks: ``(vec_id, label, code, error)``, and an array for each part.

    A component x counts as the integer floor(``scale`` * x). The codebooks start
    as the parts of the ``entries`` smallest ids and go through ``rounds`` Lloyd
    rounds with componentwise floored means; entries without points stay.
    ``code`` has two hex digits (indexes from 0) for each part, ``error`` is the
    squared distance to the coded vector.

    Vectors that are null or hold a null or non-finite component are dropped.
    The coded length is that of the smallest id whose length is a positive multiple
    of ``parts``; vectors of other lengths, and those with components so large
    that squared distances leave 64 bits, stay with a null ``code`` and ``error``
    and shape no codebook. Null ids come last, rows of equal ids are ordered by
    their vectors. With fewer vectors than ``entries`` the codebooks are shorter.
    Repeated rows count each, other columns are ignored. Empty table: no rows and no codebooks.
    """
    if parts < 1 or not 1 <= entries <= 256:
        raise ValueError("parts must be positive and entries 1 to 256")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label).alias("label"),
                     F.col(vector).cast("array<double>").alias("vec"))
    fine = "vec is not null and forall(vec, v -> v is not null and not isnan(v) and abs(v) < double('infinity'))"
    # each squared distance is at most size * (2 * largest) ** 2
    small = (f"size(vec) > 0 and size(vec) % {parts} = 0 and "
             f"forall(vec, v -> abs(v) * {scale} < least({1 << 30}, sqrt({1 << 60} / size(vec))))")
    rows = rows.where(fine).withColumn("small", F.expr(small))
    first = [F.col("vec_id").asc_nulls_last(), F.col("vec")]
    head = rows.where("small").orderBy(*first).select(F.size("vec").alias("n")).first()
    plain = rows.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"),
                        "small", F.size("vec").alias("size"))
    if head is None:
        return plain.drop("small", "size"), []
    coded = F.col("small") & (F.size("vec") == head["n"])
    ints = rows.where(coded).withColumn("ints", F.transform("vec", lambda v: F.floor(v * scale).cast("int")))
    start = np.array([r["ints"] for r in ints.orderBy(*first).select("ints").limit(entries).collect()], np.int64)
    books = [np.ascontiguousarray(b) for b in np.split(start, parts, axis=1)]
    held = blocks(ints, parts, block_rows)
    for _ in range(rounds):
        books = lloyd_round(held, books)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = _points(batch, i, parts)
                at = [t.nearest(p, b) for t, p, b in zip(_trees(batch, i), own, books)]
                error = sum(((p - b[c]) ** 2).sum(1) for p, b, c in zip(own, books, at))
                text = np.array(at, np.uint8).T.tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_ids"][i].values, batch["labels"][i].values,
                     pa.array([text[2 * parts * k:2 * parts * (k + 1)] for k in range(len(error))], pa.string()),
                     pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    kind = rows.schema["label"].dataType.simpleString()
    found = held.mapInArrow(code, f"vec_id long, label {kind}, code string, error long")
    return found.unionByName(plain.where(~F.col("small") | (F.col("size") != head["n"])).drop("small", "size")), books


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``: the sum of ``error`` over equal labels, nulls together."""
    coded = materialize(coded, "codes")
    sums = coded.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("__label"))).drop("__label")


def codebook_text(books: list[np.ndarray]) -> str:
    """All components by part, entry and place, joined by commas."""
    return ",".join(str(int(x)) for b in books for x in b.ravel())
