"""Token counts by offset-mapped attribution.

A document is encoded once, as a whole; its tokens' byte lengths give each
token's character span, and an interval join of those spans with the sections
of the document gives every token to a section. A token that crosses a
boundary is allocated by an explicit rule.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import ByteBPE

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
RULES = ("start", "end", "longest")


class Encoder:
    """A byte-level BPE and the byte length of each of its tokens."""

    def __init__(self, ranks_file: bytes) -> None:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines())}
        self.bpe = ByteBPE(ranks)
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        self.width[list(ranks.values())] = [len(t) for t in ranks]

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Character spans of the tokens; a token inside a character covers that character."""
        ids = self.bpe.encode(text)
        ends = np.cumsum(self.width[ids])
        starts = ends - self.width[ids]
        if text.isascii():
            return starts, ends
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80) - 1  # the character of each byte
        return char[starts], char[ends - 1] + 1


def allocate(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of them reach beyond it.

    ``bounds`` are the sections' first characters, ascending from 0. ``start``
    gives a token to the section of its first character, ``end`` to that of its
    last one, ``longest`` to the section holding most of its characters (the
    first of equals).
    """
    first = np.searchsorted(bounds, starts, "right") - 1
    last = np.searchsorted(bounds, ends - 1, "right") - 1
    owner = first if rule == "start" else last
    if rule == "longest":
        owner = first.copy()
        for t in np.flatnonzero(first != last):  # only tokens that cross a boundary
            cuts = np.concatenate(([starts[t]], bounds[first[t] + 1:last[t] + 1], [ends[t]]))
            owner[t] = first[t] + int(np.argmax(np.diff(cuts)))
    n = len(bounds)
    return np.bincount(owner, minlength=n), np.bincount(owner[first != last], minlength=n)


def section_tokens(df: DataFrame, *, id_col: str = "doc_id", fields: list[str] = ("text",), separator: str = "\n",
                   joiner: str = "\n", rule: str = "start", vocabulary: str = VOCABULARY) -> DataFrame:
    """Token counts by field and section: one row per document, field and section.

    The fields of a row are joined by ``joiner`` to one document, which is
    encoded once. A section is a run of characters up to and with the next
    ``separator`` (the joiner belongs to the field before it). Returns ``doc_id``,
    ``field``, ``section`` (from 0 in each field), ``start_char`` (in the
    document), ``n_chars``, ``n_tokens`` and ``n_crossing`` (of them, those that
    reach into another section). Token counts of a document add up to its whole
    encoding.

    Null fields count as empty; an empty field has one section, which may hold
    the joiner. Strings of special tokens are ordinary text. A null id stays
    null, repeated rows are counted each, other columns are ignored. The
    vocabulary file is read by the driver and broadcast (about 1 MB). Empty
    table: no rows.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    fields = list(fields)
    with open(vocabulary, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"),
                     *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"f{i}") for i, c in enumerate(fields)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            doc, names, numbers, at, chars, tokens, crossing = [], [], [], [], [], [], []
            columns = [batch[f"f{i}"].to_pylist() for i in range(len(fields))]
            for r, parts in enumerate(zip(*columns)):
                bounds, begin = [], 0
                for k, part in enumerate(parts):
                    cuts, i = [0], part.find(separator)
                    while i >= 0:
                        if i + len(separator) < len(part):
                            cuts.append(i + len(separator))
                        i = part.find(separator, i + len(separator))
                    bounds += [begin + c for c in cuts]
                    names += [fields[k]] * len(cuts)
                    numbers += range(len(cuts))
                    begin += len(part) + len(joiner)
                text, edges = joiner.join(parts), np.array(bounds, np.int64)
                # of empty sections at one place, the last owns what starts there
                owned, beyond = allocate(*encoder.spans(text), edges, rule)
                doc.append(np.full(len(edges), r))
                at.append(edges)
                chars.append(np.diff(np.append(edges, len(text))))
                tokens.append(owned)
                crossing.append(beyond)
            if doc:
                cat = [pa.array(np.concatenate(v)) for v in (at, chars, tokens, crossing)]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(pa.array(np.concatenate(doc))), pa.array(names, pa.string()),
                     pa.array(numbers, pa.int32()), *cat],
                    ["doc_id", "field", "section", "start_char", "n_chars", "n_tokens", "n_crossing"])

    return rows.mapInArrow(count, "doc_id long, field string, section int, start_char long, n_chars long, "
                                  "n_tokens long, n_crossing long")
