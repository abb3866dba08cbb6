"""Substring dedup with prefix-partitioned suffix trees over words.

Suffixes that can share their first ``length`` words are brought together by a
prefix condition, group by group, each group small enough for one task's
memory, and the suffix tree of each group gives its repeats.

1. Each window of ``length`` words has a landmark: the word sequence of least
   hash that starts in it. Equal windows have equal landmarks at equal places,
   so only landmarks found in two different texts can belong to a repeat.
2. The windows of one landmark lie side by side; the text they cover travels
   once, as a fragment, to the landmark's group. Equal fragments are combined
   before the shuffle.
3. A group's suffixes (one per window) are sorted, as the leaves of the suffix
   tree; neighbours that share at least ``length`` words hang under one deep
   internal node. The node's smallest document decides for all its suffixes.
4. A group with too many fragments takes longer prefixes: its suffixes are dealt
   out by all of their first ``length`` words, where a group is one deep node and
   a smallest document combined before the shuffle.

Texts that occur more than once go through this once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sinks.tables import materialize

LANDMARK_WORDS = 8
_FACTOR = 0x9E3779B97F4A7C15  # odd, so it can be inverted modulo 2^64
_INVERSE = pow(_FACTOR, -1, 1 << 64)
LAST = (1 << 63) - 1  # stands for a null id: after every id


class _Powers:
    """Powers of the hash factor and of its inverse, grown as texts need them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            grown = []
            for f in (_FACTOR, _INVERSE):
                steps = np.full(size, f, np.uint64)
                steps[0] = 1
                grown.append(np.cumprod(steps))
            self.up, self.down = grown
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, unchanged."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def landmarks(words: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The landmarks of all windows: hash, first window and last window of each, in order."""
    none = np.zeros(0, np.int64)
    if len(words) < length:
        return none.view(np.uint64), none, none
    k = min(LANDMARK_WORDS, length)
    line = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    up, down = _POWERS.upto(len(line) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((line.astype(np.uint64) + np.uint64(1)) * up[:len(line)])))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate((np.zeros(1, np.int64), ends[:-1]))
    n = len(words) - k + 1
    h = _mixed((sums[ends[k - 1:]] - sums[starts[:n]]) * down[starts[:n]])
    span = length - k + 1
    views = np.lib.stride_tricks.sliding_window_view(h, span)
    at = np.empty(len(views), np.int64)
    for i in range(0, len(views), 1 << 14):  # the first of equal least hashes
        at[i:i + (1 << 14)] = views[i:i + (1 << 14)].argmin(1)
    at += np.arange(len(views))
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.concatenate((first[1:], [len(at)])) - 1
    return h[at[first]], first, last


def deep_nodes(fragments: list[bytes], lows: list[int], length: int) -> list[list[int]]:
    """For each fragment, the smallest document of the deep node over each of its suffixes of ``length`` words or more.

    Suffixes are sorted, each with a space behind its last word, so that all that
    start with the same words stand together; neighbours with ``length`` words in
    common are leaves of one deep node.
    """
    leaves = []
    for f, fragment in enumerate(fragments):
        ends = list(accumulate(len(w) + 1 for w in fragment.split(b" ")))
        starts, line = [0, *ends], fragment + b" "
        for w in range(len(ends) - length + 1):
            leaves.append((line[starts[w]:], ends[w + length - 1] - starts[w], f))
    leaves.sort(key=lambda leaf: leaf[0])
    out: list[list[int]] = [[] for _ in fragments]
    order: list[list[tuple[int, int]]] = [[] for _ in fragments]
    i = 0
    while i < len(leaves):
        suffix, depth, _ = leaves[i]
        prefix, j = suffix[:depth], i + 1
        while j < len(leaves) and leaves[j][1] == depth and leaves[j][0].startswith(prefix):
            j += 1
        low = min(lows[leaf[2]] for leaf in leaves[i:j])
        for leaf in leaves[i:j]:
            order[leaf[2]].append((len(leaf[0]), low))
        i = j
    for f, found in enumerate(order):
        out[f] = [low for _, low in sorted(found, reverse=True)]  # longer suffixes start earlier
    return out


def _digest(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def _thin(docs: DataFrame, length: int) -> DataFrame:
    """One row per document: id, key of its word sequence, counts, hash, landmark hashes."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts, hashes, marks = [], [], [], []
            for t in batch["text"].to_pylist():
                words = words_of(t)
                keys.append(_digest(words))
                counts.append(len(words))
                hashes.append(hashlib.sha256(b" ".join(words)).digest())
                marks.append(np.unique(landmarks(words, length)[0]).view(np.int64))
            cut = np.concatenate(([0], np.cumsum([len(m) for m in marks]))).astype(np.int32)
            flat = np.concatenate(marks) if marks else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["raw"], pa.array(keys, pa.binary()), pa.array(counts, pa.int64()),
                 pa.array(hashes, pa.binary()), pa.ListArray.from_arrays(pa.array(cut), pa.array(flat, pa.int64()))],
                ["doc_id", "raw", "tkey", "n_words", "sha", "marks"])

    return docs.mapInArrow(scan, "doc_id long, raw long, tkey binary, n_words long, sha binary, marks array<long>")


def _fragments(texts: DataFrame, length: int) -> DataFrame:
    """Fragments of the shared landmarks: one row per text, landmark and fragment with the first windows it covers."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for tkey, low, text, shared in zip(*(batch[c].to_pylist() for c in ("tkey", "low", "text", "marks"))):
                words = words_of(text)
                h, first, last = landmarks(words, length)
                h = h.view(np.int64)
                found: dict[bytes, tuple] = {}
                for i in np.flatnonzero(np.isin(h, np.asarray(shared, np.int64))).tolist():
                    a = int(first[i])
                    piece = b" ".join(words[a:int(last[i]) + length])
                    found.setdefault(piece, (int(h[i]), []))[1].append(a)
                out += [(mark, xxhash.xxh3_128_digest(piece), piece, tkey, low, at) for piece, (mark, at) in found.items()]
                if len(out) > 4000:
                    yield batch_of(out)
                    out = []
            if out:
                yield batch_of(out)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*out))
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          ["mark", "fkey", "piece", "tkey", "low", "at"])

    return texts.mapInArrow(cut, "mark long, fkey binary, piece binary, tkey binary, low long, at array<int>")


def _trees(groups: DataFrame, length: int) -> DataFrame:
    """Deep nodes of each landmark's group: ``(fkey, lows)``, the smallest document for each window of a fragment."""
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark, group = None, []
        for batch in batches:
            keys, lows_of = [], []
            for row in zip(*(batch[c].to_pylist() for c in ("mark", "fkey", "piece", "low"))):
                if row[0] != mark:
                    answer(group, keys, lows_of)
                    mark, group = row[0], []
                group.append(row)
            if keys:
                yield pack(keys, lows_of)
        keys, lows_of = [], []
        answer(group, keys, lows_of)
        if keys:
            yield pack(keys, lows_of)

    def answer(group: list[tuple], keys: list, lows_of: list) -> None:
        keys += [g[1] for g in group]
        lows_of += deep_nodes([g[2] for g in group], [g[3] for g in group], length) if len(group) > 1 else [
            [g[3]] * (g[2].count(b" ") + 2 - length) for g in group]

    def pack(keys: list, lows_of: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(lows_of, pa.list_(pa.int64()))],
                                          ["fkey", "lows"])

    return (groups.select("mark", "fkey", "piece", "low").repartition("mark").sortWithinPartitions("mark")
            .mapInArrow(solve, "fkey binary, lows array<long>"))


def _long_prefixes(groups: DataFrame, length: int) -> DataFrame:
    """The same for groups too large for a task: suffixes dealt out by their first ``length`` words."""
    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for fkey, piece, low in zip(*(batch[c].to_pylist() for c in ("fkey", "piece", "low"))):
                words = piece.split(b" ")
                out += [(fkey, w, xxhash.xxh3_128_digest(b" ".join(words[w:w + length])), low)
                        for w in range(len(words) - length + 1)]
            for i in range(0, len(out), 20_000):
                cols = list(zip(*out[i:i + 20_000]))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int32()),
                                                  pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.int64())],
                                                 ["fkey", "w", "prefix", "low"])

    suffixes = groups.mapInArrow(leaves, "fkey binary, w int, prefix binary, low long")
    nodes = suffixes.groupBy("prefix").agg(F.min("low").alias("low"))
    return (suffixes.select("fkey", "w", "prefix").join(nodes, "prefix").groupBy("fkey")
            .agg(F.transform(F.sort_array(F.collect_list(F.struct("w", "low"))), lambda s: s["low"]).alias("lows")))


def remove_repeats(df: DataFrame, *, id_col: str = "doc_id", text: str = "text", length: int = 50,
                   group_limit: int = 20_000) -> DataFrame:
    """What is left of each document without passages of an earlier one.

    A word goes if a window of ``length`` consecutive words covers it whose word
    sequence also starts in a document with a smaller id; windows are judged on
    the input. Returns ``doc_id``, ``n_words``, ``n_removed``, ``kept`` (the kept
    words joined by one space; null where nothing was removed, so that untouched
    texts need not travel) and ``kept_sha256`` (of the kept words in any case),
    one row per input row.

    Null and blank texts have no words. A null id counts as larger than every
    id. Rows with the same id never remove from each other, unless a smaller id
    has the passage too; repeated rows get equal results. Other columns are
    ignored. Empty table: no rows. ``group_limit``: fragments of one landmark
    that a task may hold; larger groups take longer prefixes.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("raw"), F.col(text).alias("text"))
    thin = materialize(_thin(docs, length), "substrings")
    lows = (thin.groupBy("tkey").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("low"), "raw")).alias("first"))
            .select("tkey", "first.low", "first.raw"))

    marks = thin.select("tkey", F.xxhash64("tkey").alias("t"), F.explode("marks").alias("mark"))
    shared = marks.groupBy("mark").agg(F.min("t").alias("a"), F.max("t").alias("b")).where("a <> b").select("mark")
    wanted = marks.select("tkey", "mark").join(shared, "mark").groupBy("tkey").agg(F.collect_set("mark").alias("marks"))
    wanted = materialize(wanted.join(lows, "tkey"), "substrings")  # texts that may hold a repeat

    # one row stands for all that have its words: the one of least id (raw tells rows without an id apart)
    texts = materialize(docs.join(wanted.withColumn("__id", F.expr(f"nullif(low, {LAST})")).withColumnRenamed("raw", "__raw"),
                                  (F.col("raw") == F.col("__raw")) & F.col("doc_id").eqNullSafe(F.col("__id")))
                        .select("tkey", "low", "text", "marks"), "substrings")
    pieces = materialize(_fragments(texts, length), "substrings")

    groups = materialize(pieces.groupBy("mark", "fkey").agg(F.min("low").alias("low"), F.first("piece").alias("piece")),
                         "substrings")
    large = groups.groupBy("mark").agg(F.count("*").alias("n")).where(F.col("n") > group_limit).select("mark")
    small_groups, large_groups = groups.join(large, "mark", "left_anti"), groups.join(large, "mark", "left_semi")
    nodes = _trees(small_groups, length).unionByName(_long_prefixes(large_groups, length))
    # the windows of each text that start in a smaller document too
    starts = F.expr("flatten(transform(at, a -> transform(filter(sequence(0, size(lows) - 1), w -> lows[w] < low), "
                    "w -> cast(a + w as int))))")
    windows = (pieces.select("fkey", "tkey", "low", "at").join(nodes, "fkey").select("tkey", starts.alias("starts"))
               .where("size(starts) > 0").groupBy("tkey").agg(F.flatten(F.collect_list("starts")).alias("starts")))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, gone = [], []
            for t, at in zip(batch["text"].to_pylist(), batch["starts"].to_pylist()):
                words = words_of(t)
                edge = np.zeros(len(words) + 1, np.int64)
                a = np.unique(np.asarray(at, np.int64))
                np.add.at(edge, a, 1)
                np.add.at(edge, a + length, -1)
                left = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                kept.append(b" ".join([words[i] for i in left]).decode("utf-8", "surrogatepass"))
                gone.append(len(words) - len(left))
            yield pa.RecordBatch.from_arrays([batch["tkey"], pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                                             ["tkey", "gone", "kept"])

    mended = (texts.select("tkey", "text").join(windows, "tkey").mapInArrow(keep, "tkey binary, gone long, kept string")
              .groupBy("tkey").agg(F.first("gone").alias("gone"), F.first("kept").alias("kept")))  # repeated rows agree
    copy = (F.coalesce("doc_id", F.lit(LAST)) > F.col("low")) & (F.col("n_words") >= length)
    rows = thin.select("doc_id", "tkey", "n_words", "sha").join(lows.drop("raw"), "tkey").withColumn("copy", copy)
    out = rows.join(mended, "tkey", "left")
    kept = F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept"))
    return (out.withColumn("kept", kept)
            .withColumn("n_removed", F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0))))
            .withColumn("kept_sha256", F.when(F.col("kept").isNotNull(), F.sha2(F.encode("kept", "UTF-8"), 256))
                        .otherwise(F.lower(F.hex("sha"))))
            .select("doc_id", "n_words", "n_removed", "kept", "kept_sha256"))
