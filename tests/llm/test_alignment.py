"""Alignment of two tokenizers against the tokenizers themselves and all pairs of tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.test_operators import ODD, docs, prose
from tidemark.llm import alignment, bpe, queries

BPE, PIECES = (f"{queries.TOKENIZERS}/{n}" for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def spans(tokens):
    at, out = 0, []
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def brute(tokenizers, text):
    """Ids of both sides, groups and all linked pairs, by comparing every token with every token."""
    a, b = tokenizers
    whole = (" " + (text or "")).encode()
    ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
    byte = bpe.byte_values()
    bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([b.id_to_piece(i) and int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
               else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return [], [], [], []
    sa, sb = spans(bytes_a), spans(bytes_b)
    cuts = sorted({e for _, e in sa} & {e for _, e in sb})
    groups = [([i for i, s in zip(ids_a, sa) if lo <= s[0] < hi], [i for i, s in zip(ids_b, sb) if lo <= s[0] < hi])
              for lo, hi in zip([0, *cuts], cuts)]
    links = [(i, j) for i, s in zip(ids_a, sa) for j, t in zip(ids_b, sb) if s[0] < t[1] and t[0] < s[1]]
    return ids_a, ids_b, groups, links


def texts():
    rng = random.Random(5)
    return [*[t for t in ODD if t is None or len(t) < 1000], "Grüße, naïve café 東京 🙂 don't 1234567", "a▁b", "<|endoftext|> <s>",
            "x  y\n\n\tz  ", "‍́", *[prose(rng, 30) for _ in range(25)], "the quick brown fox", "the quick brown fox"]


@pytest.mark.parametrize("frequent", [0, 40, 1 << 19])
def test_alignment_against_all_pairs(spark, tokenizers, frequent):
    given = texts()
    df = docs(spark, given, ids=[None if i == 3 else i for i in range(len(given))], extra=["n_a", "row", "links"]).repartition(3)
    aligned = alignment.align(df, bpe_vocabulary=BPE, piece_vocabulary=PIECES)
    got = {r.doc_id: r for r in alignment.link_scores(aligned, frequent).collect()}
    assert len(got) == len(given)
    found = [brute(tokenizers, t) for t in given]
    held = Counter(p for _, _, _, links in found for p in set(links))
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    for i, (ids_a, ids_b, groups, links) in enumerate(found):
        r = got[None if i == 3 else i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (len(ids_a), len(ids_b), len(groups), len(links))
        assert r.groups == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        assert r.count_sum == sum(held[p] for p in links) and r.n_best == sum(held[p] == most[p[0]] for p in links)


def test_alignment_links_of_a_text(spark, tokenizers):
    df = docs(spark, ["Grüße an alle 1234567, naïve words"])
    row = alignment.align(df, bpe_vocabulary=BPE, piece_vocabulary=PIECES).first()
    assert Counter({(x.a, x.b): x.n for x in row.links}) == Counter(brute(tokenizers, "Grüße an alle 1234567, naïve words")[3])


def test_alignment_query_and_empty_table(spark, tmp_path):
    docs(spark, ["one two", None]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op11_align_tokenizers(spark, str(tmp_path)).collect()}
    text = alignment.align(docs(spark, ["one two"]), bpe_vocabulary=BPE, piece_vocabulary=PIECES).first().groups
    assert got[0].groups_sha256 == hashlib.sha256(text.encode()).hexdigest() and got[1].groups_sha256 == ""
    empty = alignment.align(docs(spark, ["x"]).limit(0), bpe_vocabulary=BPE, piece_vocabulary=PIECES)
    assert alignment.link_scores(empty).count() == 0


def test_bpe_equals_the_tokenizer_for_every_character(tokenizers):
    own = bpe.ByteBPE(bpe.json_ranks(open(BPE, "rb").read()))
    points = [c for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    given = [f"a{chr(c)}b1{chr(c)}2 {chr(c)} {chr(c)}{chr(c)} x{chr(c)}\n{chr(c)}." for c in points]
    for want, t in zip(tokenizers[0].encode_batch_fast(given, add_special_tokens=False), given):
        assert own.encode(t).tolist() == want.ids, ascii(t)


@pytest.mark.parametrize("before, run, after", [("x", " ", "y"), ("", "\n", "."), ("a ", "\t ", ""), ("", " 　", "é"), ("1", "\r\n", "\n z")])
def test_long_white_space_is_cut_as_the_pattern_cuts_it(monkeypatch, before, run, after):
    own = bpe.ByteBPE(bpe.json_ranks(open(BPE, "rb").read()))
    text = before + run * 400 + after + before + run * 300 + after
    want = own.encode(text).tolist()
    monkeypatch.setattr(bpe, "LONG", 100)
    monkeypatch.setattr(bpe, "_RUN", bpe.re.compile(bpe._RUN.pattern.replace("50000", "100")))
    assert own.encode(text).tolist() == want
    monkeypatch.undo()
    assert len(own.encode(before + run * 1_000_000 + after)) > 10


def test_very_long_texts(spark):
    df = docs(spark, [" " * 2_000_000, "a" * 300_000, "é\n" * 200_000])
    got = alignment.link_scores(alignment.align(df, bpe_vocabulary=BPE, piece_vocabulary=PIECES)).collect()
    assert all(r.n_a > 0 and r.n_links == r.n_a + r.n_b - r.n_groups for r in got)


def test_dictionaries_are_arrays_over_the_places_of_a_text():
    with open(BPE, "rb") as f, open(PIECES, "rb") as g:
        aligner = alignment.Aligner(f.read(), g.read())
    texts = [t for t in ODD if t] + ["naïve  日本語 <0x41> 👩‍👩‍👧", prose(random.Random(31), 500)]
    for text, found in zip(texts, aligner.tokens(texts)):
        if found is None:
            continue
        at_a, at_b, last_a, last_b = aligner.shared(*found)
        ends = []
        for side, ids, at in zip((aligner.a, aligner.b), found, (at_a, at_b)):
            assert len(at) == len((" " + text).encode()) + 1
            want = {end: i for i, (_, end) in enumerate(spans([side.bytes[x] for x in ids]))}
            assert {end: i for end, i in enumerate(at.tolist()) if i >= 0} == want
            ends.append(want)
        common = sorted(ends[0].keys() & ends[1].keys())
        assert last_a.tolist() == [ends[0][e] for e in common] and last_b.tolist() == [ends[1][e] for e in common]
