"""Packing documents into windows by non-negative least squares.

A document's ids fill whole windows first; what is left over, its rest, has
fewer ids than a window. Rests are counted by length in units. Shallow
combinations of lengths that fill a window are enumerated, their repeat counts
are solved against that histogram by non-negative least squares and rounded to
what the histogram holds. Rests are dealt to the combinations by their rank
among rests of their length. The residual rests are packed greedily: cut along
running totals, they fill what rounding to units left free in the sequences,
then windows of their own, and at last sequences whose lengths are powers of
two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.bpe import WordBPE
from tidemark.llm.common import running_totals
from tidemark.sinks.tables import materialize

ROW_BITS = 33  # monotonically_increasing_id: partition above, place in the partition below
BROADCAST_ROWS = 1 << 18
PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
TEXTS_A_YIELD, CHARS_A_YIELD = 1024, 1 << 22


def encoded(df: DataFrame, vocabulary: str, end_id: int, window: int, unit: int, id_col: str, text: str) -> DataFrame:
    """One row per document, written once.

    ``at`` is the row's key, ``n`` its ids, ``fulls`` the whole windows in it and ``fulls_before`` those before it
    in its partition; ``rest`` is the number of ids left over, ``bin`` that in units, ``nth`` the place among rests of that bin
    in the partition; ``crcs`` has the crc32 of each whole window and of the rest, ``ids`` the rest itself.
    """
    with open(vocabulary, "rb") as f:
        file = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, seen, before = WordBPE(file.value), Counter(), 0
        kind = "<u2" if max(bpe.largest, end_id) < 1 << 16 else "<u4"
        for batch in batches:
            out: list[tuple] = []
            chars = first = 0
            for i, t in enumerate(batch["text"]):
                t = t.as_py() or ""
                ids = np.append(bpe.encode(t), end_id).astype("<u4")
                fulls, rest = divmod(len(ids), window)
                crcs = [zlib.crc32(ids[k:k + window].tobytes()) for k in range(0, len(ids), window)]
                of = -(-rest // unit)
                out.append((len(ids), fulls, before, rest, of, seen[of], crcs, ids[fulls * window:].astype(kind).tobytes()))
                before += fulls
                seen[of] += 1
                chars += len(t)
                if i + 1 == batch.num_rows or len(out) == TEXTS_A_YIELD or chars > CHARS_A_YIELD:
                    yield pa.RecordBatch.from_arrays(
                        [batch["at"][first:i + 1], batch["doc_id"][first:i + 1]] + [pa.array(c, k) for c, k in zip(
                            zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(),
                                        pa.list_(pa.int64()), pa.binary()))],
                        ["at", "doc_id", "n", "fulls", "fulls_before", "rest", "bin", "nth", "crcs", "ids"])
                    out, chars, first = [], 0, i + 1

    rows = df.select(F.monotonically_increasing_id().alias("at"), F.col(id_col).cast("long").alias("doc_id"),
                     F.col(text).cast("string").alias("text"))
    return materialize(rows.mapInArrow(run, "at long, doc_id long, n long, fulls long, fulls_before long, rest int, "
                                            "bin int, nth long, crcs array<long>, ids binary"), "packing")


def fillings(units: int, lengths: list[int]) -> np.ndarray:
    """Shallow combinations of ``lengths`` that add up to ``units``: a row each, a count for each length.

    All of at most three pieces, and all of two different lengths in any number.
    """
    own, found = sorted(lengths, reverse=True), set()
    have = set(own)
    for i, a in enumerate(own):
        for b in own[i:]:
            if (c := units - a - b) <= b and c in have:
                found.add((a, b, c))
        for n in range(1, units // a + 1):
            left = units - n * a
            if not left:
                found.add((a,) * n)
            found.update((a,) * n + (b,) * (left // b) for b in own[i + 1:] if left >= b and left % b == 0)
    place = {u: i for i, u in enumerate(lengths)}
    out = np.zeros((len(found), len(lengths)))
    for k, combination in enumerate(sorted(found, reverse=True)):
        for u in combination:
            out[k, place[u]] += 1
    return out


def non_negative_least_squares(m: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x >= 0 of least |m x - y|, by active sets: at most one positive value for each row of ``m``."""
    x = np.zeros(m.shape[1])
    used = np.zeros(m.shape[1], bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(m.T @ y).max(initial=0)))
    for _ in range(4 * m.shape[0]):
        gain = np.where(used, -np.inf, m.T @ (y - m @ x))
        if not len(gain) or gain.max() <= tolerance:
            break
        used[gain.argmax()] = True
        while True:
            at = np.flatnonzero(used)
            own = m[:, at]
            gram = own.T @ own
            solved = np.linalg.solve(gram + np.eye(len(at)) * 1e-10 * np.trace(gram), own.T @ y)
            if not len(at) or solved.min() > 0:
                x[:] = 0
                x[at] = solved
                break
            low = solved <= 0
            step = (x[at][low] / np.maximum(x[at][low] - solved[low], 1e-300)).min()
            x[at] += step * (solved - x[at])
            x[at[low & (x[at] <= 1e-12 * max(1.0, x.max()))]] = 0
            used &= x > 0
    return x


def repeats(counts: dict[int, tuple[int, int]], window: int, unit: int) -> list[tuple[dict[int, int], int]]:
    """How often each combination is taken: ``({length in units: pieces}, sequences)``.

    ``counts`` has the number of rests and their ids for each length in units.
    Taken counts never pass the histogram. If what is left over cannot fill
    the space that rounding up to units leaves free, so many sequences are given up that it can.
    """
    lengths = sorted(u for u, (n, _) in counts.items() if n)
    m = fillings(window // unit, lengths) if lengths else np.zeros((0, 0))
    if not len(m):
        return []
    have = np.array([counts[u][0] for u in lengths], np.int64)
    weight = np.array(lengths, np.float64)  # a missed rest costs its length
    x = non_negative_least_squares((m * weight).T, have * weight)
    taken = np.zeros(len(m), np.int64)
    chosen = np.flatnonzero(x > 0)
    pieces, left = m.astype(np.int64), have.copy()
    for k in chosen[np.argsort(-x[chosen], kind="stable")]:  # rounded down
        some = pieces[k] > 0
        taken[k] = min(int(x[k] + 1e-9), int((left[some] // pieces[k][some]).min()))
        left -= taken[k] * pieces[k]
    for k in chosen[np.argsort(-(x - np.floor(x))[chosen], kind="stable")]:  # and up, by the largest remainders
        if taken[k] < x[k] and (left >= pieces[k]).all():
            taken[k] += 1
            left -= pieces[k]
    ids = sum(t for _, t in counts.values())
    if taken.sum() * window > ids:
        taken = (taken * (ids / (taken.sum() * window))).astype(np.int64)
    return [({u: int(p) for u, p in zip(lengths, pieces[k]) if p}, int(taken[k])) for k in np.flatnonzero(taken)]


def _spans(spark: SparkSession, chosen: list[tuple[dict[int, int], int]]) -> DataFrame:
    """For each bin, which ranks go to which combination: a few hundred rows."""
    rows, upto, sequence = [], Counter(), 0
    for pieces, times in chosen:
        slot = 0
        for u in sorted(pieces, reverse=True):
            rows.append((u, upto[u], upto[u] + pieces[u] * times, sequence, pieces[u], slot))
            upto[u] += pieces[u] * times
            slot += pieces[u]
        sequence += times
    return (spark.createDataFrame(rows, "bin int, low long, high long, first long, pieces long, slot long")
            .groupBy("bin").agg(F.collect_list(F.struct("low", "high", "first", "pieces", "slot")).alias("spans")))


def _tail(size: int, begin: int, first: int) -> list[tuple[int, int, int]]:
    """The last positions as sequences whose lengths are powers of two: ``(low, high, sequence)``."""
    out = []
    while size:
        n = 1 << (size.bit_length() - 1)
        out.append((begin, begin + n, first + len(out)))
        begin, size = begin + n, size - n
    return out


def pack(df: DataFrame, *, vocabulary: str, end_id: int, window: int = 4096, unit: int = 16, id_col: str = "doc_id",
         text: str = "text") -> DataFrame:
    """All documents packed into sequences: a row per piece of a document.

    A document is its ids by the word BPE at ``vocabulary``, without added
    special tokens, and ``end_id``. Returns ``doc_id``, ``start`` (its document's ids before it),
    ``length``, ``ids_crc32`` (of the ids as little-endian unsigned 32-bit numbers), ``doc_tokens``,
    ``sequence_id`` and ``offset`` (in the sequence, gapless from 0). Sequences have at most ``window`` ids. ``unit`` is the
    step of the histogram and must divide ``window``.

    Only residual rests are cut further than into windows and a rest. If they
    have fewer ids than the free space, which happens when hardly any document is left over, the sequences
    after them keep up to a few units of padding; else no sequence needs any.

    Null and empty texts are documents of ``end_id`` alone. A null id stays null, repeated rows are packed each, other
    columns are ignored. Empty table: no rows. The driver sees the histogram
    (``window / unit`` rows), the solved counts and two totals; documents
    are ranked by totals per partition and bin, so a bin may hold any part of them.
    """
    if unit < 1 or window % unit:
        raise ValueError("unit must divide window")
    spark = df.sparkSession
    docs = encoded(df, vocabulary, end_id, window, unit, id_col, text)
    part = F.shiftright("at", ROW_BITS)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)

    rests = docs.where("rest > 0").select("at", part.alias("part"), "doc_id", "n", "rest", "bin", "nth",
                                          F.element_at("crcs", -1).alias("crc"))
    counts = {r["bin"]: (r["n"], r["ids"]) for r in rests.groupBy("bin").agg(
        F.count("*").alias("n"), F.sum("rest").alias("ids")).collect()}  # at most window / unit rows
    chosen = repeats(counts, window, unit)
    combined = sum(times for _, times in chosen)

    heads = (rests.groupBy("part", "bin").agg(F.count("*").alias("n")).withColumn(
        "head", F.coalesce(F.sum("n").over(Window.partitionBy("bin").orderBy("part")
                                           .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n"))
    hit = F.expr("get(filter(spans, s -> rank >= s.low and rank < s.high), 0)")
    placed = materialize(
        rests.join(heads, ["part", "bin"]).withColumn("rank", F.col("head") + F.col("nth"))
        .join(F.broadcast(_spans(spark, chosen)), "bin", "left").withColumn("hit", hit)
        .select("at", "doc_id", "n", "rest", "crc",
                F.expr("hit.first + (rank - hit.low) div hit.pieces").alias("sequence_id"),
                F.expr("hit.slot + (rank - hit.low) % hit.pieces").alias("slot")), "packing")

    upto = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    dealt = placed.where("sequence_id is not null")
    combos = dealt.select(
        "doc_id", (F.col("n") - F.col("rest")).alias("start"), F.col("rest").cast("long").alias("length"),
        F.col("crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), "sequence_id",
        F.coalesce(F.sum("rest").over(upto), F.lit(0)).cast("long").alias("offset"))

    per_part = docs.groupBy(part.alias("part")).agg(F.sum("fulls").alias("fulls"))
    full_heads = per_part.select("part", F.coalesce(F.sum("fulls").over(before), F.lit(0)).alias("head"))
    whole = (docs.where("fulls > 0").withColumn("part", part).join(F.broadcast(full_heads), "part")  # a row per partition
             .select("doc_id", "n", "head", "fulls_before", F.posexplode(F.expr("slice(crcs, 1, int(fulls))")))
             .select("doc_id", (F.col("pos").cast("long") * window).alias("start"), F.lit(window).cast("long").alias("length"),
                     F.col("col").alias("ids_crc32"), F.col("n").alias("doc_tokens"),
                     (F.col("head") + F.col("fulls_before") + F.col("pos") + combined).alias("sequence_id"),
                     F.lit(0).cast("long").alias("offset")))
    n_whole = per_part.agg(F.sum("fulls").alias("n")).first()["n"] or 0

    free = running_totals(dealt.groupBy("sequence_id").agg(F.sum("rest").alias("used")).where(f"used < {window}")
                          .withColumn("free", F.lit(window) - F.col("used")), "free", "low")
    loose = running_totals(placed.where("sequence_id is null").select("at", "n", "rest"), "rest", "low")
    space, left = ((t.agg(F.sum(c).alias("n")).first()["n"] or 0) for t, c in ((free, "free"), (loose, "rest")))
    base, n_windows = combined + n_whole, max(0, left - space) // window

    def bucketed(t: DataFrame, low: str, high: str) -> DataFrame:  # a row for each of the one or two buckets it reaches into
        return t.withColumn("bucket", F.explode(F.expr(f"sequence({low} div {window}, ({high} - 1) div {window})")))

    ends = bucketed(loose.select("at", "n", "rest", F.col("low").alias("a"), F.expr(f"least(low + rest, {space}L)").alias("b"))
                    .where("a < b"), "a", "b")
    gaps = bucketed(free.select("sequence_id", "used", F.col("low").alias("c"), (F.col("low") + F.col("free")).alias("d")), "c", "d")
    fill = (ends.join(gaps, "bucket").where(f"a < d and c < b and bucket = greatest(a, c) div {window}")
            .select("at", F.expr("n - rest + greatest(a, c) - a").alias("start"),
                    F.expr("least(b, d) - greatest(a, c)").alias("length"), "sequence_id",
                    F.expr("used + greatest(a, c) - c").alias("offset")))
    tails = _tail(max(0, left - space) % window, n_windows * window, base + n_windows)
    tail = ", ".join(f"struct({a}L as lo, {b}L as hi, {s}L as sequence_id)" for a, b, s in tails)
    own = f"array(struct(w * {window} as lo, (w + 1) * {window} as hi, w + {base}L as sequence_id))"
    beyond = (loose.select("at", "n", "rest", "low", (F.col("low") - space).alias("p")).where("p + rest > 0")
              .withColumn("w", F.explode(F.expr(f"sequence(greatest(p, 0L) div {window}, (p + rest - 1) div {window})")))
              .withColumn("s", F.explode(F.expr(f"if(w < {n_windows}, {own}, array({tail}))" if tail else own)))
              .where("s.lo < p + rest and s.hi > p")
              .select("at", F.expr("n - rest + greatest(p, s.lo) - p").alias("start"),
                      F.expr("least(p + rest, s.hi) - greatest(p, s.lo)").alias("length"), "s.sequence_id",
                      F.expr("greatest(p, s.lo) - s.lo").alias("offset")))
    cuts = materialize(fill.unionByName(beyond).groupBy("at").agg(  # a rest has fewer pieces than ids, so fewer than window
        F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("cuts")), "packing")
    size = cuts.agg(F.count("*").alias("docs"), F.sum(F.size("cuts")).alias("pieces"), F.min("at").alias("least")).first()
    residual = docs.where(F.col("at") >= (size["least"] or 0)).select("at", "doc_id", "n", "ids")
    residual = residual.join(F.broadcast(cuts) if (size["pieces"] or 0) <= BROADCAST_ROWS else cuts, "at")

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, n, width, ids, pieces in zip(*(batch[c].to_pylist() for c in ("doc_id", "n", "rest", "ids", "cuts"))):
                rest = np.frombuffer(ids, f"<u{len(ids) // width}").astype("<u4")
                for p in pieces:
                    at = p["start"] - (n - len(rest))
                    out.append((doc, p["start"], p["length"], zlib.crc32(rest[at:at + p["length"]].tobytes()), n,
                                p["sequence_id"], p["offset"]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], PIECE)

    residual = residual.withColumn("rest", (F.col("n") % window).cast("int")).mapInArrow(
        checked, ", ".join(f"{c} long" for c in PIECE))
    return combos.unionByName(whole).unionByName(residual)
