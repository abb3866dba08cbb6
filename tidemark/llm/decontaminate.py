"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages, weighted by TF-IDF with document
frequencies counted over the whole corpus, and a randomised SVD of the passage
matrix gives a latent space. Every passage of every document is folded into
that space and compared with the benchmark passages by cosine; candidates are
checked by the longest common subsequence of words and, where that leaves room
for paraphrase, by the item's answer.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches
from tidemark.sinks.tables import materialize

ROW_BITS = 33  # monotonically_increasing_id: partition above, place in the partition below
LEAST_WORDS = 5  # items of fewer words are matched as exact runs of words
ANSWER_WORDS, ANSWER_SHARE = 8, 4  # an answer is checked by at most so many words, and one in so many of the passage's
ANSWER_LEAST = 3  # one in so many of them must be there, rounded up
TERMS = 1024  # of a product's rows in a batch
REGIONS = 512  # of a text, whose words are compared with the passages' words in one product
RARE_LEAST = 0.4  # of a paraphrased passage's rarer words; those it replaced are all among them
LETTERS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))  # other ASCII becomes a space
HIGH = re.compile(b"[\xe0-\xff]")  # first bytes of characters from U+0800 on
# Ranges of scripts that are written without spaces (Thai to Khmer, kana, Han).
UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
                      "\U00020000-\U0003ffff])")


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words; ASCII punctuation parts words, and in scripts without spaces each character is one."""
    raw = (text or "").lower().encode("utf-8", "replace")
    if HIGH.search(raw):
        raw = UNSPACED.sub(r" \1 ", (text or "").lower()).encode("utf-8", "replace")
    return raw.translate(LETTERS).split()


def answer_of(text: str, least: int = 4) -> list[bytes]:
    """The words an answer check looks for: the last sentence, with at least ``least`` words of the item."""
    words, last = words_of(text), []
    for sentence in reversed(text.replace("!", ".").replace("?", ".").replace("\n", ".").split(".")):
        if last := words_of(sentence):
            break
    return words[-max(least, len(last)):]


def telling_words(answer: list[bytes], n: int) -> list[bytes]:
    """The longest words of an answer, in its order, for a passage of ``n`` words.

    Not those of greatest IDF: words that a paraphrase replaced are rarer in the corpus for that very reason.
    """
    most = min(ANSWER_WORDS, -(-n // ANSWER_SHARE))
    best = sorted(range(len(answer)), key=lambda i: (-len(answer[i]), -i))[:most]
    return [answer[i] for i in sorted(best)]


def rare_words(words: list[bytes], weights: list[float]) -> list[bytes]:
    """The words of a passage that are among the rarer half of its distinct words, in their order."""
    by_weight = sorted(dict(zip(words, weights)).items(), key=lambda x: (-x[1], x[0]))
    rare = {w for w, _ in by_weight[:-(-len(by_weight) // 2)]}
    return [w for w in words if w in rare]


def places_of(words: list[bytes]) -> dict[bytes, int]:
    """A word's places as bits, as ``common_words`` takes them."""
    bits: dict[bytes, int] = {}
    for i, w in enumerate(words):
        bits[w] = bits.get(w, 0) | 1 << i
    return bits


def common_words(item: dict[bytes, int], n: int, region: list[bytes]) -> int:
    """Length of the longest common subsequence; ``item`` maps a word to the bits of its places, ``n`` long."""
    full = (1 << n) - 1
    v = full
    for w in region:
        m = item.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def most_common(holds: np.ndarray, at: np.ndarray, part: np.ndarray, first: int, last: int, span: int) -> np.ndarray:
    """For regions ``first`` to ``last`` (excluded) and every passage, the passage's words that the region holds in any order.

    No common subsequence is longer. A region is ``span`` parts of a text, from the part before the one of its own
    number on; ``at`` are the rows in ``holds`` of the text's words that have one, ``part`` their parts, ascending,
    and ``holds`` has each word's count in each passage.
    """
    begin, end = np.searchsorted(part, (first - 1, last + span - 2))
    used, place = np.unique(at[begin:end], return_inverse=True)
    held = np.zeros((last - first + span - 1, len(used)), np.float32)
    held[part[begin:end] - (first - 1), place] = 1
    region = held[:last - first].copy()
    for k in range(1, span):
        np.maximum(region, held[k:k + last - first], out=region)
    return region @ holds[used].astype(np.float32)


def _passages(items: DataFrame, window: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, t in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist()):
                words = words_of(t)
                parts = -(-len(words) // window) if len(words) >= LEAST_WORDS else 0
                for k in range(parts):  # of even length, so that no short rest is left
                    piece = words[k * len(words) // parts:(k + 1) * len(words) // parts]
                    # the last passage has the item's answer, the others are told by their own words
                    out.append((i, k, piece, answer_of(t) if k == parts - 1 else piece))
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                                                  pa.array(cols[2], pa.list_(pa.binary())),
                                                  pa.array(cols[3], pa.list_(pa.binary()))],
                                                 ["item_id", "part", "words", "answer"])

    return items.mapInArrow(cut, "item_id long, part int, words array<binary>, answer array<binary>")


def document_frequencies(docs: DataFrame, terms: list[bytes]) -> tuple[np.ndarray, int]:
    """Documents that hold each of ``terms``, over all of ``docs`` (a column ``text``), and the number of documents."""
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, seen, n = shared.value, Counter(), 0
        known = vocabulary.keys()
        for batch in batches:
            n += batch.num_rows
            for t in batch["text"].to_pylist():
                seen.update(known & set(words_of(t)))
        ids = [-1, *(vocabulary[t] for t in seen)]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array([n, *seen.values()], pa.int64())],
                                         ["term", "n"])

    with small_batches(docs.sparkSession):
        rows = docs.select("text").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df, n = np.zeros(len(terms), np.int64), 0
    for r in rows:  # one row per benchmark term
        if r["term"] < 0:
            n = r["n"]
        else:
            df[r["term"]] = r["n"]
    return df, n


def randomised_svd(rows: DataFrame, n_terms: int, rank: int, rounds: int = 2, seed: int = 42) -> np.ndarray:
    """Right singular vectors (terms x rank) of a sparse matrix by random projection.

    ``rows`` has ``ids array<int>`` and ``vals array<double>``, one row of the matrix
    each. Every round multiplies a terms x rank block by the matrix and its
    transpose in the tasks and sums by term; the driver holds blocks of terms x
    rank numbers only.
    """
    sc = rows.sparkSession.sparkContext

    def times(block: np.ndarray) -> np.ndarray:
        shared = sc.broadcast(block)

        def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for ids, vals in zip(batch["ids"].to_pylist(), batch["vals"].to_pylist()):
                    y = np.asarray(vals) @ shared.value[ids]
                    for i, v in zip(ids, vals):
                        total[i] = total.get(i, 0.0) + v * y
            terms, width = np.fromiter(total, np.int32, len(total)), block.shape[1]
            for i in range(0, len(terms), TERMS):
                sums = np.concatenate([total.pop(t) for t in terms[i:i + TERMS].tolist()])
                ends = pa.array(np.arange(0, len(sums) + 1, width, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(terms[i:i + TERMS]), pa.ListArray.from_arrays(ends, pa.array(sums))],
                                                 ["term", "v"])

        sums = [F.sum(F.col("v")[j]).alias(f"v{j}") for j in range(block.shape[1])]
        got = rows.mapInArrow(product, "term int, v array<double>").groupBy("term").agg(*sums).toArrow()
        out = np.zeros(block.shape)
        out[got["term"].to_numpy()] = np.column_stack([got[f"v{j}"].to_numpy() for j in range(block.shape[1])])
        return out

    block = np.random.default_rng(seed).standard_normal((n_terms, min(rank, n_terms)))
    for _ in range(rounds):
        block = np.linalg.qr(times(block))[0]
    values, turn = np.linalg.eigh(block.T @ times(block))
    keep = values > values.max(initial=0) * 1e-9
    return block @ turn[:, keep][:, ::-1]


class Runs:
    """Items of fewer than ``LEAST_WORDS`` words, found as exact runs of words.

    An item of one word would be found nearly everywhere: it only matches a text that is that word.
    """

    def __init__(self, items: list[tuple[int, list[bytes]]]) -> None:
        self.alone: dict[bytes, list[int]] = {}
        words = sorted({w for _, ws in items for w in ws if len(ws) > 1})
        self.number = {w: i + 1 for i, w in enumerate(words)}
        self.base = len(words) + 1
        self.items: dict[int, dict[int, list[int]]] = {}  # by length and by the run's number
        for item, ws in items:
            if len(ws) == 1:
                self.alone.setdefault(ws[0], []).append(item)
            else:
                self.items.setdefault(len(ws), {}).setdefault(self._code([self.number[w] for w in ws]), []).append(item)
        self.codes = {n: np.array(sorted(c), np.int64) for n, c in self.items.items()}
        if self.base ** (LEAST_WORDS - 1) >= 1 << 63:
            raise ValueError("too many different words in short items")

    def _code(self, numbers: list[int]) -> int:
        code = 0
        for x in numbers:
            code = code * self.base + x
        return code

    def found(self, words: list[bytes]) -> set[int]:
        """The items that a text holds."""
        out = set(self.alone.get(words[0], ())) if len(words) == 1 else set()
        if self.items:
            ids = np.fromiter(map(self.number.get, words, repeat(0)), np.int64, len(words))
            for n, codes in self.codes.items():
                if len(ids) < n or not len(codes):
                    continue
                code, whole = np.zeros(len(ids) - n + 1, np.int64), np.ones(len(ids) - n + 1, bool)
                for k in range(n):
                    own = ids[k:len(ids) - n + 1 + k]
                    code, whole = code * self.base + own, whole & (own > 0)
                for c in np.unique(code[whole & np.isin(code, codes)]).tolist():
                    out.update(self.items[n][c])
        return out


# A latent space over some passages, as plain values that travel in a broadcast: the row of each word (-1: none),
# the space, the folded passages, for each its item and the places and number of its words, its rare words and its answer,
# how often each passage holds each word, and the passages' numbers of words.
Block = tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple], np.ndarray, np.ndarray]


def contaminated(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text", block_passages: int = 256, rank_share: float = 0.75,
                 window: int = 64, cosine: float = 0.4, copied: float = 0.8, paraphrased: float = 0.5,
                 blocks_a_scan: int = 64) -> DataFrame:
    """Documents that hold a benchmark item: ``(doc_id, item_id, cosine, lcs, n_passages)``, a row per pair.

    A pair is reported if a candidate passage has a longest common subsequence
    of at least ``copied`` of the benchmark passage's words, or of at least
    ``paraphrased`` of them, with two fifths of the words that are among the rarer half of its own (ordinary
    text shares the others), and its answer: a third, by their own longest common
    subsequence, of at most eight words, the longest of the item's last sentence
    for its last passage and the longest of their own for the others. ``lcs`` is the best such share, ``cosine`` the best
    latent cosine and ``n_passages`` the number of benchmark passages found.
    Documents are folded in by halves of ``window`` words; a passage is two
    halves. Candidates need a latent cosine of ``cosine``.

    The benchmark is a stated query set, broadcast in blocks of at most
    ``block_passages`` neighbouring passages, each with a latent space of ``rank_share`` times as many
    dimensions (1.0: passages are held whole). Frequencies of all its
    words are counted in one scan of the documents, and ``blocks_a_scan`` blocks are
    searched in one. The exact way past the candidates is ``cosine=-1``, which checks
    every passage of every document.

    Items of fewer than five words are found as exact runs of words, an item of
    one word only as a whole text; their cosine and lcs are 1. In scripts written without spaces
    a character counts as a word. Null and empty texts and items give no rows. A null id
    stays null, repeated rows give repeated rows. Other columns are ignored. Empty tables: no rows.
    """
    if block_passages < 1 or not 0 < rank_share <= 1 or blocks_a_scan < 1:
        raise ValueError("block_passages and blocks_a_scan must be positive, rank_share over 0 and at most 1")
    spark = docs.sparkSession
    corpus = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    given = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    passages = _passages(given, window).collect()  # the stated query set
    passages.sort(key=lambda p: (p["item_id"] is None, p["item_id"] or 0, p["part"], p["words"]))
    short = sorted({(r["item_id"], tuple(bytes(w) for w in r["words"])) for r in _short_items(given).collect()},
                   key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    if not passages and not short:
        return spark.createDataFrame([], "doc_id long, item_id long, cosine double, lcs double, n_passages long")
    terms = sorted({bytes(w) for p in passages for w in p["words"]})
    number = {t: i for i, t in enumerate(terms)}
    df, n = document_frequencies(corpus, terms) if terms else (np.zeros(0, np.int64), 0)
    idf = np.log((n + 1) / (df + 1)) + 1e-3
    count = -(-len(passages) // block_passages)
    cuts = [k * len(passages) // count for k in range(count + 1)] if count else [0]
    blocks = [_block(spark, passages[a:b], number, idf, rank_share) for a, b in zip(cuts, cuts[1:])]
    found = None
    for k in range(0, max(1, len(blocks)), blocks_a_scan):
        runs = [(i, list(ws)) for i, ws in short] if k == 0 else []
        part = _search(corpus, number, blocks[k:k + blocks_a_scan], runs, window, cosine, copied, paraphrased)
        found = part if found is None else found.unionByName(part)
    return found.groupBy("row", "doc_id", "item_id").agg(
        F.max("cosine").alias("cosine"), F.max("lcs").alias("lcs"), F.count("*").alias("n_passages")).drop("row")


def _short_items(items: DataFrame) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(i, ws) for i, t in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist())
                   if 0 < len(ws := words_of(t)) < LEAST_WORDS]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], pa.int64()),
                                              pa.array([ws for _, ws in out], pa.list_(pa.binary()))], ["item_id", "words"])

    return items.mapInArrow(cut, "item_id long, words array<binary>")


def _block(spark, passages: list, number: dict[bytes, int], idf: np.ndarray, rank_share: float) -> Block:
    """The latent space of some passages: a randomised SVD of their TF-IDF matrix, in tasks."""
    own = [[number[bytes(w)] for w in p["words"]] for p in passages]
    used = sorted({i for ids in own for i in ids})
    local = np.full(len(number), -1, np.int64)
    local[used] = np.arange(len(used))
    weight = idf[used]
    rows = [(list(c), [k * float(weight[i]) for i, k in c.items()]) for ids in own for c in [Counter(local[ids].tolist())]]
    matrix = materialize(spark.createDataFrame(rows, "ids array<int>, vals array<double>"), "decontaminate")
    rank = max(1, int(np.ceil(rank_share * len(passages))))
    space = (randomised_svd(matrix, len(used), rank) * weight[:, None]).astype(np.float32)
    folded = np.array([space[local[ids]].sum(0) for ids in own], np.float32)
    folded /= np.maximum(np.linalg.norm(folded, axis=1, keepdims=True), 1e-12)
    places = []
    for p in passages:
        words = [bytes(w) for w in p["words"]]
        answer = telling_words([bytes(w) for w in p["answer"]][-len(words):], len(words))
        rare = rare_words(words, [float(idf[number[w]]) for w in words])
        places.append((p["item_id"], *(x for ws in (words, rare, answer) for x in (places_of(ws), len(ws)))))
    lengths = np.array([len(ids) for ids in own])
    holds = np.zeros((len(used), len(passages)), np.min_scalar_type(lengths.max()))
    for j, ids in enumerate(own):
        np.add.at(holds[:, j], local[ids], 1)
    return local, space, np.ascontiguousarray(folded.T), places, holds, lengths


def _search(corpus: DataFrame, number: dict[bytes, int], blocks: list[Block], short: list[tuple[int, list[bytes]]],
            window: int, least: float, copied: float, paraphrased: float) -> DataFrame:
    """One scan: every passage of every document against all passages of ``blocks``, and the short items."""
    shared = corpus.sparkSession.sparkContext.broadcast((number, blocks, short))
    half = window // 2
    span = -(-(window + 2 * half) // half)  # halves that a candidate's region touches

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, own, given = shared.value
        runs = Runs(given)
        for batch in batches:
            out: list[tuple] = []
            for r, t in enumerate(batch["text"].to_pylist()):
                words = words_of(t)
                out += [(r, item, 1.0, 1.0) for item in runs.found(words)]
                ids = np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int64, len(words))
                known = np.flatnonzero(ids >= 0)
                for block in own if len(known) else ():
                    out += [(r, *x) for x in candidates(block, words, ids[known], known)]
            if out:
                cols = list(zip(*out))
                rows = pa.array(cols[0], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch["row"].take(rows), batch["doc_id"].take(rows), pa.array(cols[1], pa.int64()),
                     pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.float64())],
                    ["row", "doc_id", "item_id", "cosine", "lcs"])

    def candidates(block: Block, words: list[bytes], ids: np.ndarray, known: np.ndarray) -> list[tuple]:
        local, space, folded, places, holds, lengths = block
        at = local[ids]
        inside = at >= 0
        at, where = at[inside], known[inside]
        if not len(at):
            return []
        part = where // half
        first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        sums = np.zeros((-(-len(words) // half) + 1, space.shape[1]), np.float32)
        sums[part[first]] = np.add.reduceat(space[at], first, axis=0)
        folds = sums[:-1] + sums[1:]  # the last one is a half alone
        folds /= np.maximum(np.sqrt(np.einsum("ij,ij->i", folds, folds)), 1e-12)[:, None]
        best: dict[int, tuple[float, float]] = {}
        for lo in range(0, len(folds), 4096):  # bounds the products of a very long text
            cos = folds[lo:lo + 4096] @ folded
            near = cos >= least
            for k in range(0, len(cos), REGIONS):  # only passages of which a region holds enough words need the subsequence
                stop = min(k + REGIONS, len(cos))
                near[k:stop] &= most_common(holds, at, part, lo + k, lo + stop, span) / lengths >= paraphrased
            for k, j in zip(*np.nonzero(near)):
                _, bits, n, rare, n_rare, answer, m = places[j]
                begin = (lo + int(k)) * half
                region = words[max(0, begin - half):begin + window + half]
                share = common_words(bits, n, region) / n
                if share < paraphrased or share <= best.get(j, (0.0, 0.0))[1]:
                    continue
                if share >= copied or (m and common_words(rare, n_rare, region) >= RARE_LEAST * n_rare
                                       and common_words(answer, m, region) >= -(-m // ANSWER_LEAST)):
                    best[j] = (max(float(cos[k, j]), best.get(j, (0.0, 0.0))[0]), share)
        return [(places[j][0], c, s) for j, (c, s) in best.items()]

    # materialised: the groups behind it must not see another numbering of rows after a lost executor
    with small_batches(corpus.sparkSession):
        return materialize(corpus.withColumn("row", F.monotonically_increasing_id())
                           .mapInArrow(search, "row long, doc_id long, item_id long, cosine double, lcs double"),
                           "decontaminate")
