"""Embedding near-duplicates: int8 tile products with per-vector error bounds.

Unit vectors x are stored as x = s q + e with int8 codes q, a scale s and the
exact length of the residual e. For two vectors
|x.y - (s q).(s' q')| <= |s q| |e'| + |e|, so the code product decides every pair
outside a narrow band round the threshold; only pairs inside the band are
recomputed in double precision from the vectors as given. Equal vectors are one
node with a multiplicity. Tiles hold a bounded number of nodes; every pair of
tiles meets in one task, which returns link counts and a spanning forest, never
its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components
from tidemark.llm.simhash import _join
from tidemark.sinks.tables import materialize

TILE_BYTES = 4 << 20  # of a tile's vectors in double precision
SLACK = 1e-5  # float32 rounding of scaled code products (the products themselves are exact integers)


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes of unit rows, their scales, the lengths of the coded rows and of the residuals."""
    scale = np.abs(x).max(1) / 127.0
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    coded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(coded, axis=1), np.linalg.norm(x - coded, axis=1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1)[:, None]  # keeps squares of very small or large components in range
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def tile_links(x: np.ndarray, y: np.ndarray, threshold: float, same: bool,
               strip: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows of ``x`` and ``y`` with cosine of at least ``threshold``, strip by strip.

    ``same``: both are one tile; each pair is given once and no row meets itself.
    """
    x, y = _unit(x), _unit(y)
    qx, sx, nx, ex = quantise(x)
    qy, sy, ny, ey = quantise(y)
    fy = qy.astype(np.float32)  # sums of int8 products stay below 2^24, where float32 is exact
    if x.shape[1] * 127 * 127 >= 1 << 24:
        fy = qy.astype(np.float64)
    sy32, ey32 = sy.astype(np.float32), ey.astype(np.float32)
    for i in range(0, len(x), strip):
        j = slice(i, i + strip)
        dots = qx[j].astype(fy.dtype) @ fy.T
        dots *= sx[j, None].astype(np.float32)
        dots *= sy32
        # |x.y - dots| <= |coded x| |e_y| + |e_x| |y|, with |y| = 1
        dots += nx[j, None].astype(np.float32) * ey32
        r, c = np.nonzero(dots >= (threshold - SLACK - ex[j]).astype(np.float32)[:, None])
        if same:
            keep = r + i < c
            r, c = r[keep], c[keep]
        if len(r):
            bound = nx[j][r] * ey[c] + ex[j][r] + SLACK
            sure = dots[r, c] - nx[j][r] * ey[c] - bound >= threshold
            open_ = np.flatnonzero(~sure)
            ok = sure.copy()
            for k in range(0, len(open_), 1 << 16):
                o = open_[k:k + (1 << 16)]
                ok[o] = np.einsum("ij,ij->i", x[r[o] + i], y[c[o]]) >= threshold
            if ok.any():
                yield r[ok] + i, c[ok]


def near_duplicates(df: DataFrame, *, id_col: str = "vec_id", vector: str = "embedding", threshold: float = 0.9,
                    tile_rows: int | None = None) -> DataFrame:
    """Links by cosine: ``(vec_id, n_links, component_id, kept)``, one row per input row.

    Cosines are taken in double precision; a pair links if its cosine is at
    least ``threshold`` (which must be over 0). ``n_links`` counts the other
    rows linked directly, ``component_id`` is the smallest id reachable, the own
    id included, ``kept`` says whether that is the own id.

    Null vectors, vectors of zeros or none at all, and vectors with a null or
    non-finite component link with nothing; so do vectors of different lengths.
    A null id is never the smallest: its row gets the smallest id of its
    component, or null, and is not kept. Repeated rows stay and count each
    other. Other columns are ignored. Empty table: no rows. All tiles of one
    vector length meet, as an exact all-pairs search needs; each task holds two
    tiles of ``tile_rows`` vectors on average (default: as many as take
    ``TILE_BYTES``). A vector travels once for each tile, so larger tiles move less.
    """
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"))
    fine = ("size(vec) > 0 and forall(vec, v -> v is not null and not isnan(v) and abs(v) < double('infinity'))"
            " and exists(vec, v -> v <> 0)")
    rows = rows.withColumn("fine", F.coalesce(F.expr(fine), F.lit(False)))
    # the node of a vector: equal vectors share it (-0.0 counts as 0.0)
    rows = rows.withColumn("vec", F.when(F.col("fine"), F.transform("vec", lambda v: v + F.lit(0.0))))
    nodes = materialize(rows.where("fine").groupBy("vec").agg(F.count("*").alias("copies"), F.min("vec_id").alias("low"))
                        .withColumn("node", F.monotonically_increasing_id()), "embeddings")
    sizes = nodes.groupBy(F.size("vec").alias("dim")).count()
    own = F.lit(tile_rows) if tile_rows else F.greatest(F.lit(1), F.floor(F.lit(TILE_BYTES) / (8 * F.col("dim"))))
    tiles = (nodes.join(sizes, F.size("vec") == F.col("dim"))
             .withColumn("tiles", F.ceil(F.col("count") / own).cast("int"))
             .withColumn("tile", F.expr("cast(pmod(xxhash64(node), tiles) as int)")))

    def pack(key, pdf: pd.DataFrame) -> pd.DataFrame:
        data = np.array(pdf["vec"].tolist(), np.float64)
        with np.errstate(over="ignore"):
            half = data.astype(np.float32)
        data = half if np.array_equal(half, data) else data  # float inputs travel as floats
        return pd.DataFrame({"dim": [key[0]], "tile": [key[1]], "tiles": [pdf["tiles"].iloc[0]],
                             "node": [pdf["node"].to_numpy(np.int64).tobytes()],
                             "copies": [pdf["copies"].to_numpy(np.int64).tobytes()], "kind": [data.dtype.str],
                             "data": [data.tobytes()]})

    packed = materialize(tiles.select("dim", "tile", "tiles", "node", "copies", "vec").groupBy("dim", "tile")
                         .applyInPandas(pack, "dim int, tile int, tiles int, node binary, copies binary, kind string, data binary"),
                         "embeddings")
    meet = (packed.withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
            .withColumn("lo", F.least("tile", "other")).withColumn("hi", F.greatest("tile", "other")))

    def match(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("tile")
        first, second = pdf.iloc[0], pdf.iloc[-1]
        same = len(pdf) == 1
        ids = [np.frombuffer(t["node"], np.int64) for t in (first, second)]
        copies = [np.frombuffer(t["copies"], np.int64) for t in (first, second)]
        x, y = (np.frombuffer(t["data"], t["kind"]).astype(np.float64).reshape(-1, key[0]) for t in (first, second))
        n = len(x)
        shift = 0 if same else n
        total = n + (0 if same else len(y))
        count, root = np.zeros(total, np.int64), np.arange(total)
        for r, c in tile_links(x, y, threshold, same):
            count[:n] += np.bincount(r, copies[1][c], n).astype(np.int64)
            count[shift:] += np.bincount(c, copies[0][r], total - shift).astype(np.int64)
            root = _join(root, r, c + shift)
        node = ids[0] if same else np.concatenate(ids)
        some = count > 0
        return pd.DataFrame({"node": node[some], "root": node[root[some]], "n": count[some]})

    if not 0 < threshold <= 1:
        raise ValueError("threshold must be over 0 and at most 1")
    found = materialize(meet.groupBy("dim", "lo", "hi").applyInPandas(match, "node long, root long, n long"), "embeddings")
    linked = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    classes = (nodes.join(found.groupBy("node").agg(F.sum("n").alias("n")), "node", "left")
               .join(linked, "node", "left").withColumn("root", F.coalesce("component", "node")))
    classes = classes.select("vec", "root", F.expr("coalesce(n, 0) + copies - 1").alias("n_links"), "low")
    lows = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = classes.join(lows, "root").select("vec", "n_links", "component_id")
    good = rows.where("fine").join(classes, "vec").select("vec_id", "n_links", "component_id")
    bad = rows.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                        F.col("vec_id").alias("component_id"))
    return good.unionByName(bad).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

