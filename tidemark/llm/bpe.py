"""Byte-level BPE of whole texts, whatever their length."""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import tiktoken
from tokenizers import Tokenizer

# Fixed value: the public word pattern of the byte-level BPE vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG = 50_000  # a longer run of white space is cut before the pattern sees it
# Fixed value: Unicode's White_Space, as the pattern's \s has it (Python's own \s has more).
_RUN = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG)


class ByteBPE:
    """Encodes texts with the ranks of a byte-level BPE; special tokens' strings are ordinary text.

    The pattern looks ahead over white space one character at a time and gives
    up on runs of about a million. Such a run is cut here as the pattern itself cuts it: all
    but the last character are one word, or the whole run at the end of a text.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.one = tiktoken.Encoding("one", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text."""
        if len(text) < LONG or not _RUN.search(text):
            return self._of(self.bpe, text)
        parts, at = [], 0
        for run in _RUN.finditer(text):
            stop = run.end() - (run.end() < len(text))
            parts += [self._of(self.bpe, text[at:run.start()]), self._of(self.one, text[run.start():stop])]
            at = stop
        return np.concatenate([*parts, self._of(self.bpe, text[at:])])

    def joined(self, ids: list[int]) -> bytes:
        """The bytes of the ids' tokens."""
        return self.bpe.decode_bytes(ids)

    @staticmethod
    def _of(encoding: tiktoken.Encoding, text: str) -> np.ndarray:
        return np.array(encoding.encode_ordinary(text), np.int64)


def byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves; the other bytes, in order, for U+0100 and on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def json_ranks(file: bytes) -> dict[bytes, int]:
    """The ranks in a byte-level vocabulary file, without its special tokens.

    Merging by rank equals merging by the file's list of merges only if ids
    follow that list, which is checked.
    """
    found = json.loads(file)
    model, byte = found["model"], byte_values()
    special = {t["content"] for t in found["added_tokens"]}
    ids = {t: i for t, i in model["vocab"].items() if t not in special}
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    if [ids[m] for m in merged] != list(range(256, 256 + len(merged))):
        raise ValueError("the ids do not follow the merges")
    return {bytes(byte[c] for c in t): i for t, i in ids.items()}


PLAIN = 0x180  # below it, lower-casing and composition look at single characters only, but for one:
DOTTED = "\u0130"  # whose lower case is two characters
WORD_END = "</w>"


def _class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(PLAIN) if unicodedata.category(chr(c))[0] == kind)


class WordBPE:
    """Encodes texts with a lower-casing byte-level BPE whose words end in ``</w>``.

    Texts of characters below ``PLAIN`` without strings of special tokens are
    cut into words here and merged in one call, a space standing for the word
    end (no word holds a space). A word's last byte takes the end first, as the
    vocabulary has it, because those ids come before all merges. All other texts go
    through the tokenizer itself; the results are the same.
    """

    def __init__(self, file: bytes) -> None:
        found = json.loads(file)
        model, byte = found["model"], byte_values()
        special = [t["content"] for t in found["added_tokens"]]
        ids = {t: i for t, i in model["vocab"].items() if t not in special}
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        ranks = {}
        for t, i in ids.items():
            whole = t.endswith(WORD_END)
            ranks[bytes(byte[c] for c in t.removesuffix(WORD_END)) + b" " * whole] = i
        single = [ids[c] for c in byte] + [ids[c + WORD_END] for c in byte]
        if sorted(single) != list(range(512)) or [ids[m] for m in merged] != list(range(512, 512 + len(merged))):
            raise ValueError("the ids do not follow the merges")
        self.largest = max([*ids.values(), *(t["id"] for t in found["added_tokens"])])
        self.whole = Tokenizer.from_str(file.decode())
        self.bpe = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        letters, numbers, blank = _class("L"), _class("N"), "\t-\r \x85\xa0"
        self.words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{letters}{numbers}{blank}]+")
        self.other = re.compile(f"[{DOTTED}\u0180-\U0010ffff]|" + "|".join(map(re.escape, special)))

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, without added special tokens."""
        if self.other.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.int64)
        words = " ".join(self.words.findall(text.lower()))
        return np.array(self.bpe.encode_ordinary(words + " ") if words else [], np.int64)
