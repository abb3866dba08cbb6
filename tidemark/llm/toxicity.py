"""Toxicity by compression distance: two zstandard dictionaries, one per kind of text.

A window is one word between two spaces. Each window is compressed twice, with
a dictionary trained on toxic text and with one trained on ordinary text; the
difference of the two lengths says which kind of text knows the word. A
document's evidence is how many of its windows pass each of a few length
thresholds, absolutely and per window, and the largest difference. A logistic
calibration of that evidence, fitted on documents that neither dictionary saw
(cross-fitting), gives the score, moved so that 0.5 is the threshold with the
best F1.
"""

from __future__ import annotations

import pickle
import random
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import without
from tidemark.sinks.tables import materialize

LETTERS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))  # other ASCII becomes a space
PAD = b"\n" * 12  # the match finder leaves the last bytes of its input alone; the same for both dictionaries
THRESHOLDS = (2, 3, 4, 6)  # bytes saved
GRAM = 5
LEVEL, MIN_MATCH = 3, 5


def windows(text: str | None) -> list[bytes]:
    """The words of a whole text, lower-cased, each with a space on both sides."""
    return [b" " + w + b" " for w in (text or "").lower().encode("utf-8", "replace").translate(LETTERS).split()]


def _grams(words) -> set[bytes]:
    return {w[i:i + GRAM] for w in words for i in range(len(w) - GRAM + 1)}


def train_dictionaries(toxic: list[list[bytes]], ordinary: list[list[bytes]], toxic_bytes: int = 4096,
                       ordinary_bytes: int = 32768, most: int = 200_000) -> tuple[bytes, bytes]:
    """The two dictionaries, from documents given as windows.

    Almost all words of a toxic document are ordinary ones, so the toxic
    dictionary is trained on the windows holding a byte sequence that toxic
    documents have at least four times as often as ordinary ones. Both draw at
    most ``most`` windows at random. An empty bytes object stands for a side
    with too little text to train on.
    """
    seen, usual = Counter(), Counter()
    for d in toxic:
        seen.update(_grams(set(d)))
    for d in ordinary:
        usual.update(_grams(set(d)))
    per = (len(ordinary) + 1) / (len(toxic) + 1)
    marked = {g for g, n in seen.items() if n >= min(5, max(2, len(toxic) // 10)) and (n + 0.5) * per >= 4 * (usual[g] + 0.5)}
    rng = random.Random(42)

    def trained(sample: list[bytes], size: int) -> bytes:
        rng.shuffle(sample)
        try:
            return zstandard.train_dictionary(size, sample[:most]).as_bytes()
        except (zstandard.ZstdError, ValueError):
            return b""

    telling: dict[bytes, bool] = {}

    def tells(w: bytes) -> bool:
        if w not in telling:
            telling[w] = any(w[i:i + GRAM] in marked for i in range(len(w) - GRAM + 1))
        return telling[w]

    return (trained([w for d in toxic for w in d if tells(w)], toxic_bytes),
            trained([w for d in ordinary for w in d], ordinary_bytes))


class Distance:
    """Difference of the compressed lengths of windows, remembered by word up to ``most`` words."""

    def __init__(self, toxic: bytes, ordinary: bytes, most: int = 500_000) -> None:
        self.sides = [self._compressor(d) for d in (ordinary, toxic)] if toxic and ordinary else None
        self.known: dict[bytes, int] = {}
        self.most = most

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        params = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, min_match=MIN_MATCH, window_log=17, write_content_size=False, write_checksum=False,
            write_dict_id=False)
        d = zstandard.ZstdCompressionDict(content)
        d.precompute_compress(compression_params=params)
        return zstandard.ZstdCompressor(compression_params=params, dict_data=d)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if self.sides is None:
            return np.zeros(len(words), np.int64)
        if len(self.known) > self.most:
            self.known.clear()
        new = list({w for w in words if w not in self.known})
        for i in range(0, len(new), 50_000):
            padded = [w + PAD for w in new[i:i + 50_000]]
            lengths = [[len(f) for f in c.multi_compress_to_buffer(padded, threads=0)] for c in self.sides]
            self.known.update(zip(new[i:i + 50_000], (a - b for a, b in zip(*lengths))))
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def evidence(self, words: list[bytes]) -> np.ndarray:
        d = self(words)
        if not len(d):
            return np.zeros(2 + 2 * len(THRESHOLDS))
        passed = np.array([np.count_nonzero(d >= t) for t in THRESHOLDS], float)
        return np.concatenate(([max(int(d.max()), 0)], np.log1p(passed), passed / len(d), [np.log1p(len(d))]))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        g = x.T @ (weight * (y - p)) - ridge * w
        h = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(texts: list[str | None], labels: list[int], weights: list[float], folds: int = 2) -> dict:
    """Dictionaries and calibration from labelled texts; ``weights`` undo the class sampling."""
    one: dict[bytes, bytes] = {}  # a word that comes again is the same object
    docs = [[one.setdefault(w, w) for w in windows(t)] for t in texts]
    y, weight = np.array(labels, float), np.array(weights, float)
    fold = np.arange(len(docs)) % folds
    x = np.zeros((len(docs), 2 + 2 * len(THRESHOLDS)))
    for k in range(folds):
        rest = [(d, v) for d, v, f in zip(docs, y, fold) if f != k]
        pair = train_dictionaries([d for d, v in rest if v], [d for d, v in rest if not v])
        distance = Distance(*pair)
        for i in np.flatnonzero(fold == k):
            x[i] = distance.evidence(docs[i])
    mean, spread = x.mean(0) if len(x) else 0.0, (x.std(0) if len(x) else 0.0) + 1e-9
    z = (x - mean) / spread
    if 0 < y.sum() < len(y):
        w = _logistic(z, y, weight)
        s = z @ w[:-1] + w[-1]
        order = np.argsort(-s, kind="stable")
        hits, all_ = np.cumsum((weight * y)[order]), np.cumsum(weight[order])
        f1 = 2 * hits / (all_ + (weight * y).sum())
        f1[:-1][s[order][:-1] == s[order][1:]] = -1  # a threshold cannot part equal scores
        best = int(np.argmax(f1))
        after = s[order][best + 1] if best + 1 < len(s) else s[order][best] - 1
        w[-1] -= (s[order][best] + after) / 2
    else:  # one class only: nothing to tell apart
        w = np.zeros(x.shape[1] + 1)
        w[-1] = 5.0 if len(y) and y.all() else -5.0
    toxic, ordinary = train_dictionaries([d for d, v in zip(docs, y) if v], [d for d, v in zip(docs, y) if not v])
    return {"toxic": toxic, "ordinary": ordinary, "mean": mean, "spread": spread, "w": w}


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
          per_class: int = 3000) -> bytes:
    """A model fitted in one task on at most ``per_class`` labelled texts of each class.

    The sample is drawn from the labels (those of documents there are): the ids
    of least crc32, a fixed draw. Only then are its texts fetched, so no other
    text is shuffled. Null ids and labels other than 0 and 1 are ignored; of
    several labels for an id the largest counts, of several texts the first in
    order; null texts count as empty. Without labelled documents the model calls
    everything ordinary.
    """
    ids = docs.select(F.col(id_col).alias("key")).where("key is not null").distinct()
    rows = (labels.where(F.col(label).isin(0, 1)).groupBy(F.col(id_col).alias("key"))
            .agg(F.max(F.col(label).cast("int")).alias("label")).join(ids, "key", "left_semi"))
    rows = materialize(rows, "toxicity")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    drawn = None
    for c in (0, 1):
        part = rows.where(F.col("label") == c).orderBy(F.crc32(F.encode(F.col("key").cast("string"), "UTF-8")),
                                                       "key").limit(per_class)
        drawn = part if drawn is None else drawn.unionByName(part)
    taken = (docs.select(F.col(id_col).alias("key"), F.col(text).alias("text"))
             .join(F.broadcast(drawn), "key")  # at most twice per_class ids
             .groupBy("key", "label").agg(F.min("text").alias("text"))
             .withColumn("key", F.col("key").cast("string")))
    share = {c: n / min(n, per_class) for c, n in counts.items()}

    def one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [*batches]
        pdf = pd.concat(got) if got else pd.DataFrame({"text": [], "label": [], "key": []})
        pdf = pdf.sort_values(["key", "label"], kind="stable")
        model = fit([t if isinstance(t, str) else None for t in pdf["text"]], pdf["label"].astype(int).tolist(),
                    [share[c] for c in pdf["label"]])
        yield pd.DataFrame({"model": [pickle.dumps(model)]})

    found = taken.coalesce(1).mapInPandas(one, "model binary").collect()  # one row of a few ten KB
    return bytes(found[0]["model"]) if found else pickle.dumps(fit([], [], []))


class Scorer:
    """A fitted model, ready to score texts in a task."""

    def __init__(self, model: bytes) -> None:
        self.m = pickle.loads(model)
        self.distance = Distance(self.m["toxic"], self.m["ordinary"])

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([self.distance.evidence(windows(t)) for t in texts]).reshape(len(texts), -1)
        s = (x - self.m["mean"]) / self.m["spread"] @ self.m["w"][:-1] + self.m["w"][-1]
        return 1 / (1 + np.exp(-np.clip(s, -35, 35)))


def score(df: DataFrame, model: bytes, *, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with a double column ``out`` from 0 to 1, higher for toxic; 0.5 is the threshold.

    Scores depend on the whole text alone. Null and empty texts have no windows
    and get the score of no evidence. An input column ``out`` is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # two dictionaries and a dozen numbers

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pd.Series(scorer([t if isinstance(t, str) else None for t in texts]))

    return without(df, [out]).withColumn(out, scored(F.col(text)))


def held_out(key: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text divides by 5."""
    return F.coalesce(F.crc32(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8")) % 5 == 0, F.lit(False))

