"""Packing: every id in exactly one piece, sequences without gaps, and the parts of the method."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.test_operators import ODD, docs, prose
from tidemark.llm import bpe, packing, queries

WORDS = f"{queries.TOKENIZERS}/word_bpe_49k.json"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


def check(tokenizer, given, got, window):
    """Every piece against the tokenizer's own ids; returns padding and ids."""
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in given}
    held, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        held[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
        own = ids[r.doc_id][r.start:r.start + r.length]
        assert r.length == len(own) > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
    assert set(held) == set(ids)
    for doc, pieces in held.items():
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
        assert at == len(ids[doc])
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding, sum(map(len, ids.values()))


@pytest.mark.parametrize("window, unit, n", [(256, 16, 300), (64, 4, 200), (4096, 16, 40), (16, 16, 20)])
def test_packing_keeps_every_id_once(spark, tokenizer, window, unit, n):
    rng = random.Random(window)
    given = list(enumerate([*ODD, *[prose(rng, rng.choice([1, 3, 20, 40, 41, 150])) for _ in range(n)]]))
    df = docs(spark, [t for _, t in given], extra=["at", "rest", "sequence_id"]).repartition(4)
    got = packing.pack(df, vocabulary=WORDS, end_id=2, window=window, unit=unit).collect()
    padding, ids = check(tokenizer, given, got, window)
    assert padding <= 0.005 * ids


def test_combinations_keep_most_rests_whole(spark, tokenizer):
    rng = random.Random(3)
    given = list(enumerate(prose(rng, rng.randint(1, 60)) for _ in range(1500)))
    got = packing.pack(docs(spark, [t for _, t in given]).repartition(3), vocabulary=WORDS, end_id=2, window=256, unit=4).collect()
    padding, ids = check(tokenizer, given, got, 256)
    assert padding <= 0.002 * ids
    rests = Counter(r.doc_id for r in got if r.length < 256)
    assert sum(n == 1 for n in rests.values()) > 0.85 * len(rests)  # cutting at every window alone would cut more


def test_packing_one_hot_length_nulls_and_empty(spark, tokenizer):
    same = docs(spark, ["one two three"] * 700 + [None, ""], ids=[None] * 700 + [1, 2]).repartition(5)
    got = packing.pack(same, vocabulary=WORDS, end_id=2, window=64, unit=4).collect()
    assert sum(r.length for r in got) == 700 * 4 + 2 and {r.doc_tokens for r in got if r.doc_id is None} == {4}
    used = Counter()
    for r in got:
        used[r.sequence_id] += r.length
    assert sum(64 - n for n in used.values() if n & (n - 1)) == 0
    assert packing.pack(docs(spark, []), vocabulary=WORDS, end_id=2).count() == 0
    with pytest.raises(ValueError):
        packing.pack(same, vocabulary=WORDS, end_id=2, window=100, unit=16)


def test_rests_beyond_the_broadcast_size(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "BROADCAST_ROWS", -1)
    rng = random.Random(8)
    given = list(enumerate(prose(rng, 90) for _ in range(60)))  # no lengths that fill a window together
    got = packing.pack(docs(spark, [t for _, t in given]), vocabulary=WORDS, end_id=2, window=256, unit=16).collect()
    assert check(tokenizer, given, got, 256)[0] <= 256


def test_non_negative_least_squares():
    rng = np.random.default_rng(1)
    for _ in range(20):
        m = rng.integers(0, 3, (6, 30)).astype(float)
        y = m @ np.maximum(0, rng.normal(0, 5, 30)) + rng.normal(0, 1, 6)
        x = packing.non_negative_least_squares(m, y)
        slope = m.T @ (m @ x - y)  # the conditions of Karush, Kuhn and Tucker
        assert (x >= 0).all() and (slope > -1e-4).all() and np.abs(slope * x).max() < 1e-2


def test_fillings_and_repeats():
    rows = packing.fillings(8, [1, 2, 3, 4, 8])
    assert {tuple(int(x) for x in r) for r in rows} >= {(0, 0, 0, 0, 1), (0, 0, 0, 2, 0), (0, 4, 0, 0, 0), (2, 0, 2, 0, 0), (1, 0, 1, 1, 0)}
    assert all(int(r @ [1, 2, 3, 4, 8]) == 8 for r in rows)
    counts = {1: (10, 150), 2: (700, 21000), 3: (31, 1400), 4: (50, 3100)}
    used = Counter()
    for pieces, times in packing.repeats(counts, 128, 16):
        assert sum(u * p for u, p in pieces.items()) == 8 and times > 0
        for u, p in pieces.items():
            used[u] += p * times
    assert all(used[u] <= n for u, (n, _) in counts.items()) and used[2] > 600
    assert packing.repeats({}, 128, 16) == []


def test_word_bpe_equals_the_tokenizer(tokenizer):
    own = bpe.WordBPE(open(WORDS, "rb").read())
    given = [f"a{chr(c)}b1{chr(c)}2 {chr(c)} {chr(c)}{chr(c)} X{chr(c)}\n{chr(c)}." for c in range(1, 0x400)]
    rng = random.Random(6)
    alphabet = [*map(chr, range(0x180)), *"'sdlrtvem \n\t" * 6, "\x1c", "Ǎ", "́", "İ", "Σ"]
    given += ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(4000)]
    given += ["<|endoftext|> x", "a<|startoftext|>", "it's 'dogs don't I'LL", "x" * 5000, " " * 3000, *[t for t in ODD if t]]
    for t, want in zip(given, tokenizer.encode_batch(given, add_special_tokens=False)):
        assert own.encode(t).tolist() == want.ids, ascii(t)


def test_very_long_texts(spark, tokenizer):
    given = list(enumerate([" " * 2_000_000, "word " * 100_000, "a" * 200_000]))
    got = packing.pack(docs(spark, [t for _, t in given]), vocabulary=WORDS, end_id=2).collect()
    assert check(tokenizer, given, got, 4096)[0] == 0
