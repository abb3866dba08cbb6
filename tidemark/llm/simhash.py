"""SimHash near-duplicates through an inverted index of positional bytes.

A 64-bit fingerprint has eight positional bytes; two fingerprints that differ
in at most three bits share at least five of them. Tallying shared bytes over
posting lists of single bytes would meet a 256th of all pairs, so the posting
lists hold four positional bytes at once: 14 position sets such that every
choice of five positions contains one of them. A pair that meets on a list has
all of its shared positions tallied, goes on if it reaches the guaranteed five,
and is verified by its bit distance. A list with too many distinct
fingerprints is dealt anew by a fifth position (a pair that passes shares one
more than the four), which leaves at most 2^24 distinct values to a list.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, small_batches
from tidemark.sinks.tables import materialize

POSITIONS = 8
_PAIRINGS = [((0, 1), (2, 3)), ((0, 2), (1, 3)), ((0, 3), (1, 2))]


def position_sets() -> list[tuple[int, ...]]:
    """14 sets of four of the eight positions; any five positions contain one of the sets.

    Two halves of four positions: each half itself, and, for each way of pairing
    off a half, its pairs joined with the pairs of the other half.
    """
    sets = [(0, 1, 2, 3), (4, 5, 6, 7)]
    for pairs in _PAIRINGS:
        sets += [(*x, *(p + 4 for p in y)) for x in pairs for y in pairs]
    return sets


def _mask(positions) -> int:
    m = sum(0xFF << (8 * p) for p in positions)
    return m - (1 << 64) if m >= 1 << 63 else m


def fingerprint(text: str | None, shingle: int, chunk: int = 1 << 15) -> int:
    """The SimHash of one text as a signed 64-bit number (see ``fingerprints``)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - width + 1
    pairs = zip(starts[:n].tolist(), ends[width - 1:].tolist())
    h = np.fromiter((xxhash.xxh64_intdigest(line[a:b], 42) for a, b in pairs), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, chunk):  # bounds the unpacked bits of a very long text
        bits = np.unpackbits(h[i:i + chunk].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, text: str = "text", shingle: int = 3, out: str = "fp") -> DataFrame:
    """``df`` with a long column ``out``: the SimHash of ``text`` over word shingles.

    A-Z is lower-cased, words are runs of anything but ASCII white space,
    shingles keep their repeats; a text of fewer words is one shingle, a null,
    empty or blank text has fingerprint zero.
    """
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return df.withColumn(out, fp(F.col(text)))


def _near(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """All linked pairs (as indices) of a list of distinct fingerprints, by tally and bit distance."""
    least = POSITIONS - distance
    a, b = [], []
    step = max(1, (1 << 20) // len(fps))
    for i in range(0, len(fps), step):
        x = fps[i:i + step, None] ^ fps[None, :]
        shared = (x.view(np.uint8).reshape(*x.shape, 8) == 0).sum(-1, dtype=np.uint8)
        r, c = np.nonzero(shared >= least)
        near = np.bitwise_count(x[r, c]) <= distance
        r, c = r[near] + i, c[near]
        keep = r < c
        a.append(r[keep])
        b.append(c[keep])
    return np.concatenate(a), np.concatenate(b)


def _probe(fps: np.ndarray, mask: int, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same links for a long list: look up every flip of at most ``distance`` free bits."""
    free = [1 << i for i in range(64) if not (mask >> i) & 1]
    for k in range(1, distance + 1):
        for bits in combinations(free, k):
            other = fps ^ np.uint64(sum(bits))
            at = np.minimum(np.searchsorted(fps, other), len(fps) - 1)
            hit = np.flatnonzero((fps[at] == other) & (fps < other))
            if len(hit):
                yield hit, at[hit]


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable, after adding the links ``a``-``b``."""
    while True:
        low = np.minimum(root[a], root[b])
        was = root.copy()
        np.minimum.at(root, was[a], low)
        np.minimum.at(root, was[b], low)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if np.array_equal(root, was):
            return root


def forest(fps: np.ndarray, mask: int, distance: int, dense: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one posting list as a forest: (fingerprint, root) where they differ."""
    root = np.arange(len(fps))
    if len(fps) <= dense:
        a, b = _near(fps, distance)
        root = _join(root, a, b) if len(a) else root
    else:
        for a, b in _probe(fps, mask, distance):
            root = _join(root, a, b)
    moved = root != np.arange(len(fps))
    return fps[moved], fps[root[moved]]


def linked_fingerprints(fps: DataFrame, distance: int = 3, list_limit: int = 4096) -> DataFrame:
    """Components of distinct fingerprints: ``(fp, root)`` for every fingerprint linked with another.

    ``fps`` has one long column ``fp``, each value once. Posting lists with more
    than ``list_limit`` members are dealt anew by a fifth position; both kinds
    give all their links, as the edges of a forest, so that no list emits its
    pairs. ``distance`` may be 1 to 3 (the position sets need five shared bytes).
    """
    if not 1 <= distance <= 3:
        raise ValueError("the position sets serve distances of 1 to 3 bits")
    masks = F.array(*[F.lit(_mask(s)) for s in position_sets()])
    index = fps.select("fp", F.explode(masks).alias("mask")).withColumn("key", F.expr("fp & mask"))
    counts = index.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    index = materialize(index.join(counts, ["mask", "key"]), "simhash")
    wider = F.array(*[F.struct(F.lit(_mask(s)).alias("mask"), F.lit(_mask((*s, p))).alias("wide"))
                      for s in position_sets() for p in range(POSITIONS) if p not in s])
    long = (index.where(F.col("n") > list_limit)
            .withColumn("w", F.explode(wider)).where("w.mask = mask")
            .select("fp", F.col("w.wide").alias("mask"), F.expr("fp & w.wide").alias("key")))
    lists = index.where(F.col("n") <= list_limit).select("fp", "mask", "key").unionByName(long.distinct())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None  # rows of the last list, which the next batch may go on with
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            kept = pa.concat_tables([kept, rows]) if kept is not None else rows
            m, k = (kept[c].to_numpy() for c in ("mask", "key"))
            cut = np.flatnonzero((m[1:] != m[:-1]) | (k[1:] != k[:-1])) + 1
            if len(cut):
                yield from scan(kept.slice(0, int(cut[-1])))
                kept = kept.slice(int(cut[-1]))
        if kept is not None and kept.num_rows:
            yield from scan(kept)

    def scan(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        m, k = (rows[c].to_numpy() for c in ("mask", "key"))
        f = rows["fp"].to_numpy().view(np.uint64)
        cut = np.concatenate(([0], np.flatnonzero((m[1:] != m[:-1]) | (k[1:] != k[:-1])) + 1, [len(m)]))
        a, b = [], []
        for i, j in zip(cut[:-1].tolist(), cut[1:].tolist()):
            if j - i > 1:
                x, y = forest(np.sort(f[i:j]), int(m[i]) & (1 << 64) - 1, distance, list_limit)
                a.append(x)
                b.append(y)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v).view(np.int64)) for v in (a, b)], ["a", "b"])

    edges = (lists.repartition("mask", "key").sortWithinPartitions("mask", "key")
             .mapInArrow(search, "a long, b long"))
    return components(edges).select(F.col("node").alias("fp"), F.col("component").alias("root"))


def near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
                    distance: int = 3, list_limit: int = 4096) -> DataFrame:
    """Near-duplicate classes: ``(doc_id, fp, component_id)``, one row per input row.

    Two documents are linked if their fingerprints differ in at most
    ``distance`` bits; ``component_id`` is the smallest id reachable over links,
    the own id included. Equal fingerprints are one node, so groups of copies
    cost one node however large they are.

    Null text counts as empty (fingerprint 0, linked like any other). A null id
    is never the smallest; a component without any id gets null. Repeated rows
    stay and get the same component. Other columns are ignored. Empty table: no
    rows.
    """
    with small_batches(df.sparkSession):
        docs = materialize(fingerprints(df.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), "text",
                                        shingle).select("doc_id", "fp"), "simhash")
    nodes = materialize(docs.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash")
    linked = linked_fingerprints(nodes.select("fp"), distance, list_limit)
    rooted = nodes.join(linked, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    classes = rooted.join(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "root")
    return docs.join(classes.select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")
