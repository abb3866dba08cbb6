"""Vector codes against a plain Lloyd iteration, and the cover tree against all distances."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    """Codes, errors and codebooks by comparing every part with every entry, in Python integers."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [[int(np.floor(4096 * float(np.float32(x)))) for x in v] for _, v, _ in rows]
    width = len(ints[0]) // parts
    cut = [[tuple(v[k * width:(k + 1) * width]) for k in range(parts)] for v in ints]
    books = [[c[k] for c in cut[:entries]] for k in range(parts)]

    def near(k, p):
        return min((sum((a - b) ** 2 for a, b in zip(p, e)), i) for i, e in enumerate(books[k]))

    for _ in range(rounds):
        after = []
        for k in range(parts):
            own = [[] for _ in books[k]]
            for c in cut:
                own[near(k, c[k])[1]].append(c[k])
            after.append([tuple(sum(x) // len(g) for x in zip(*g)) if g else e for g, e in zip(own, books[k])])
        books = after
    found = [[near(k, c[k]) for k in range(parts)] for c in cut]
    out = [(r[0], r[2], "".join(f"{i:02x}" for _, i in f), sum(d for d, _ in f)) for r, f in zip(rows, found)]
    return out, ",".join(str(x) for b in books for e in b for x in e)


def vectors(rng, n, dim=16, spread=0.1):
    centres = [[rng.gauss(0, 0.3) for _ in range(dim)] for _ in range(5)]
    return [[float(np.float32(x + rng.gauss(0, spread))) for x in rng.choice(centres)] for _ in range(n)]


@pytest.mark.parametrize("n, block", [(300, 64), (300, 4096), (9, 4), (1, 4)])
def test_codes_against_plain_lloyd(spark, n, block):
    rng = random.Random(n + block)
    rows = [(i * 3 % n * 7, v, rng.choice([None, 0, 1, 2])) for i, v in enumerate(vectors(rng, n))]
    rows += [(rows[0][0], rows[0][1], 1), (None, rows[-1][1], None)] * (n > 20)  # a repeated row, rows without id
    rows += [(900 + i, [-0.5] * 16, 0) for i in range(40)] * (n > 20)  # many equal vectors
    bad = [(-1, None, 0), (-2, [0.1] * 15 + [None], 0), (-3, [float("nan")] * 16, 1), (-4, [float("inf")] * 16, None)]
    odd = [(-5, [0.1] * 3, 0), (-6, [], 0), (-7, [1e30] * 16, 0)]
    df = spark.createDataFrame(rows + bad + odd, SCHEMA).repartition(3).withColumns({"code": F.lit(1), "ints": F.lit(2)})
    coded, books = codes.compress(df, block_rows=block)
    got = codes.label_errors(coded).collect()
    want, text = brute(rows)
    assert codes.codebook_text(books) == text
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.vec_id, r.label, r.code, r.error) for r in got if r.code), key=key) == sorted(want, key=key)
    assert sorted(r.vec_id for r in got if not r.code) == [-7, -6, -5] and all(r.error is None for r in got if not r.code)
    for r in got:
        assert r.label_error == sum(e for _, label, _, e in want if label == r.label) or not any(w[1] == r.label for w in want)


def test_cover_tree_finds_the_nearest():
    rng = np.random.default_rng(4)
    for n, d, spread in [(1, 2, 9), (500, 8, 400), (700, 2, 3), (400, 3, 1), (2000, 4, 100000)]:
        points = rng.integers(-spread, spread, (n, d))
        tree = codes.CoverTree(points)
        assert sorted(tree.order.tolist()) == list(range(n))
        for lo, hi, radius, sums in zip(tree.low, tree.high, tree.radius, tree.sums):
            own = points[tree.order[lo:hi]]
            assert np.sqrt(((own - own[0]) ** 2).sum(1)).max() <= radius and (own.sum(0) == sums).all()
        for entries in (points[:7], rng.integers(-spread, spread, (16, d)), np.zeros((3, d), np.int64)):
            want = codes.squares(points, entries).argmin(1)
            assert (tree.nearest(points, entries) == want).all()
            sums, counts = np.zeros_like(entries), np.zeros(len(entries), np.int64)
            tree.tally(points, entries, sums, counts)
            assert (counts == np.bincount(want, minlength=len(entries))).all()
            assert all((sums[i] == points[want == i].sum(0)).all() for i in range(len(entries)))


def test_cover_tree_assigns_whole_subtrees():
    rng = np.random.default_rng(4)
    centres = rng.integers(-4000, 4000, (16, 8))
    points = centres[rng.integers(0, 16, 4000)] + rng.integers(-100, 100, (4000, 8))
    tree = codes.CoverTree(points)
    whole = sum(int((tree.high - tree.low)[at].sum()) for w, at, _ in tree.assign(points, centres) if w)
    assert whole == len(points)


def test_codes_empty_and_unusable_tables(spark):
    empty, books = codes.compress(spark.createDataFrame([], SCHEMA))
    assert not books and codes.label_errors(empty).count() == 0
    none, books = codes.compress(spark.createDataFrame([(1, None, 1), (2, [1.0], None)], SCHEMA))
    assert not books and [(r.vec_id, r.code, r.label_error) for r in codes.label_errors(none).collect()] == [(2, None, None)]
    assert hashlib.sha256(codes.codebook_text([]).encode()).hexdigest()
