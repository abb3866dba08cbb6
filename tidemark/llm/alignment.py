"""Cross-tokenizer alignment by the ends that both token sequences share.

Both tokenizers cut the same bytes, so the cumulative byte ends of their tokens
can be compared. Ends go into dictionaries from end to token index; the ends in
both dictionaries, sorted, slice the two id lists into groups. Inside a group no
other end is shared, and its links are the pairs of tokens whose bytes overlap.
As ends are places in a text, a dictionary is an array with an entry per place.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import ByteBPE, json_ranks
from tidemark.sinks.tables import materialize

SPACE = "▁"
DOCS_A_YIELD, CHARS_A_YIELD = 512, 1 << 21
FREQUENT = 1 << 19  # id pairs whose counts are broadcast; the others' counts are joined
LINK = "array<struct<a: int, b: int, n: int>>"


class Tokens:
    """The bytes of a vocabulary's tokens, and their ids as text."""

    def __init__(self, tokens: list[bytes], last: str) -> None:
        self.bytes = tokens
        self.width = np.array([len(t) for t in tokens], np.int64)
        names = [str(i) for i in range(len(tokens))]
        self.names = np.array([n + "," for n in names] + [n + last for n in names], object)

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def named(self, ids: np.ndarray, closing: np.ndarray) -> np.ndarray:
        return self.names[ids + closing * len(self.bytes)]


def piece_bytes(piece: str) -> bytes:
    """The bytes of a piece: U+2581 is a space, <0xHH> a byte."""
    if re.fullmatch("<0x[0-9A-F]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(SPACE, " ").encode()


class Aligner:
    """Encodes texts with both vocabularies and aligns the tokens."""

    def __init__(self, bpe_file: bytes, piece_file: bytes) -> None:
        ranks = json_ranks(bpe_file)
        self.bpe = ByteBPE(ranks)
        table = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            table[i] = token
        self.a = Tokens(table, "|")
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=None, model_proto=piece_file)
        self.b = Tokens([piece_bytes(self.pieces.id_to_piece(i)) for i in range(self.pieces.get_piece_size())], ";")

    def tokens(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """The ids of every text, or None where the tokens are not the bytes of a space and the text."""
        for text, b in zip(texts, self.pieces.encode(texts, num_threads=1, out_type="numpy")):
            whole = " " + text
            raw, a = whole.encode("utf-8", "replace"), self.bpe.encode(whole)
            same = self.bpe.joined(a.tolist()) == raw and self.b.joined(b.tolist()) == raw
            yield (a, b.astype(np.int64)) if text and same else None

    def shared(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
        """The dictionaries from cumulative ends to token indexes (-1: no token ends there) of both sides, and the
        last token of either side in each group."""
        at_a, at_b = (self._places(side, ids) for side, ids in ((self.a, a), (self.b, b)))
        common = np.flatnonzero((at_a >= 0) & (at_b >= 0))
        return at_a, at_b, at_a[common].astype(np.int64), at_b[common].astype(np.int64)

    @staticmethod
    def _places(side: Tokens, ids: np.ndarray) -> np.ndarray:
        ends = np.cumsum(side.width[ids])
        at = np.full(ends[-1] + 1, -1, np.int32)
        at[ends] = np.arange(len(ids), dtype=np.int32)
        return at

    def groups_text(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group."""
        n = len(last_a)
        closing_a, closing_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        closing_a[last_a] = closing_b[last_b] = 1
        size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        group = np.arange(n)
        out = np.empty(len(a) + len(b), object)
        out[np.arange(len(a)) + (last_b - size_b + 1)[np.repeat(group, size_a)]] = self.a.named(a, closing_a)
        out[np.arange(len(b)) + (last_a + 1)[np.repeat(group, size_b)]] = self.b.named(b, closing_b)
        return "".join(out.tolist())[:-1]

    def links(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray,
              at_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Linked id pairs, each once, and how many links each has.

        The ends of both sides cut a slice into stretches that lie in one token
        of either side; two tokens overlap in one stretch, so each stretch is a
        link. All slices of a text are expanded together, as none reaches into
        another.
        """
        in_a, in_b = at_a >= 0, at_b >= 0
        ends = np.flatnonzero(in_a | in_b)
        own_a, own_b = (np.cumsum(x) - x for x in (in_a[ends], in_b[ends]))  # tokens that end before
        pairs = a[own_a] * len(self.b.bytes) + b[own_b]
        pairs, n = np.unique(pairs, return_counts=True)
        return pairs // len(self.b.bytes), pairs % len(self.b.bytes), n


def _blocks(texts: list[str]) -> Iterator[slice]:
    """Slices of a batch with a bounded number of texts and, but for one long text, of characters."""
    start = chars = 0
    for i, t in enumerate(texts):
        if i > start and (i - start >= DOCS_A_YIELD or chars + len(t) > CHARS_A_YIELD):
            yield slice(start, i)
            start, chars = i, 0
        chars += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def align(df: DataFrame, *, bpe_vocabulary: str, piece_vocabulary: str, id_col: str = "doc_id",
          text: str = "text") -> DataFrame:
    """The alignment of two tokenizers over every text, one row per input row.

    ``bpe_vocabulary`` (A) is a byte-level BPE in JSON and encodes a space and
    the text, ``piece_vocabulary`` (B) is a sentencepiece model that adds the
    space by itself. Returns ``doc_id``, ``n_a`` and ``n_b`` (tokens),
    ``n_groups``, ``groups`` (ids of the groups as text: ``a1,a2|b1;a3|b2,b3``)
    and ``links`` (linked id pairs ``a``, ``b``, each once, with their ``n`` links).

    Null and empty texts, and texts whose tokens of either side do not join to
    the space and the text, have no tokens: zeros, empty ``groups`` and
    ``links``. Strings of special tokens are ordinary text. A null id stays
    null, repeated rows stay, other columns are ignored. Empty table: no rows.
    The driver reads both vocabulary files and broadcasts them (2 MB).
    """
    with open(bpe_vocabulary, "rb") as f, open(piece_vocabulary, "rb") as g:
        files = df.sparkSession.sparkContext.broadcast((f.read(), g.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*files.value)
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            for part in _blocks(texts):
                rows, links = [], []
                for found in aligner.tokens(texts[part]):
                    if found is None:
                        rows.append((0, 0, 0, ""))
                        links.append((np.zeros(0, np.int64),) * 3)
                        continue
                    a, b = found
                    at_a, at_b, last_a, last_b = aligner.shared(a, b)
                    rows.append((len(a), len(b), len(last_a), aligner.groups_text(a, b, last_a, last_b)))
                    links.append(aligner.links(a, b, at_a, at_b))
                n_a, n_b, n_groups, groups = zip(*rows)
                leaves = [pa.array(np.concatenate(x), pa.int32()) for x in zip(*links)]
                offsets = np.cumsum([0, *(len(x[0]) for x in links)])
                linked = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                                  pa.StructArray.from_arrays(leaves, ["a", "b", "n"]))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][part.start:part.stop], pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()),
                     pa.array(n_groups, pa.int64()), pa.array(groups, pa.string()), linked],
                    ["doc_id", "n_a", "n_b", "n_groups", "groups", "links"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n_a long, n_b long, n_groups long, groups string, links {LINK}")


def pair_counts(links: DataFrame) -> DataFrame:
    """``(a, b, docs, best)`` of rows ``(row, a, b, n)``: the documents that hold a pair linked, and whether
    no other pair of its A id has more."""
    counts = materialize(links.groupBy("a", "b").agg(F.count("*").alias("docs")), "alignment")
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))  # at most one row per A id
    return counts.join(most, "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).alias("best"))


def link_scores(aligned: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``aligned`` (see ``align``) with ``n_links``, ``n_best`` and ``count_sum`` in place of ``links``.

    A pair's count is the number of rows that hold it linked. ``n_best`` counts
    the links whose pair has its A id's highest count, ties included;
    ``count_sum`` adds the counts over the links.

    The counts of the ``frequent`` most frequent pairs at most are broadcast;
    only links of rarer pairs are joined by a shuffle, so no pair that many
    documents share meets in one task. Each distinct pair of a document is one
    row before the shuffle.
    """
    rows = materialize(aligned.withColumn("row", F.monotonically_increasing_id()), "alignment")
    links = rows.select("row", F.explode("links").alias("l")).select("row", "l.*")
    counts = materialize(pair_counts(links), "alignment")
    sizes = {r["scale"]: r["pairs"] for r in counts.groupBy(F.floor(F.log2("docs")).alias("scale")).agg(
        F.count("*").alias("pairs")).collect()}  # at most 63 rows
    all_, least, held = sum(sizes.values()), None, 0
    for scale in sorted(sizes, reverse=True):  # the pairs in 2 ** scale documents or more
        held += sizes[scale]
        least = 1 << scale if held <= frequent else least
    if all_ <= frequent:
        scored = links.join(F.broadcast(counts), ["a", "b"])
    elif least is None:
        scored = links.join(counts, ["a", "b"])
    else:
        hot, cold = counts.where(F.col("docs") >= least), counts.where(F.col("docs") < least)
        rest = links.join(F.broadcast(hot.select("a", "b")), ["a", "b"], "left_anti")
        scored = links.join(F.broadcast(hot), ["a", "b"]).unionByName(rest.join(cold, ["a", "b"]))
    sums = scored.groupBy("row").agg(F.sum("n").alias("n_links"), F.sum(F.expr("if(best, n, 0)")).alias("n_best"),
                                     F.sum(F.col("n") * F.col("docs")).alias("count_sum"))
    zero = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_links", "n_best", "count_sum")}
    return rows.drop("links").join(sums, "row", "left").drop("row").withColumns(zero)
