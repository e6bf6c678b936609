"""Token ids of a public word-level BPE tokenizer, over whole Arrow columns.

``tokenizers`` splits a text into pieces (letter runs, single digits, runs of
other marks), and the ids of a piece do not depend on its neighbours.  So each
distinct piece goes through the library's model once a worker, and texts are
put together from the pieces' ids with numpy.  The split is made with numpy for
texts of ``_EASY`` characters, whose lower case and character classes are plain;
other texts, and tokenizers with another normaliser or split, go through the
library word by word, or whole.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from quarterlens.llm.textkernel import piece_hashes

#: The normaliser and the split for which the numpy path holds.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

#: ASCII and the Latin letters whose lower case is one letter of the same kind.
_EASY = re.compile("[\t\n\r\x20-\x7eÀ-ÖØ-öø-įı-ňŊ-ž]*")
_BLANKS = re.compile(r"[\t\n\r ]+")
#: Characters that are split at once, and pieces that a worker remembers.
BLOCK = 1 << 20
MEMORY = 2_000_000

_BLANK, _LETTER, _DIGIT, _MARK = range(4)
_CLASS = np.full(256, _MARK, dtype=np.uint8)
_CLASS[[9, 10, 13, 32]] = _BLANK
_CLASS[48:58] = _DIGIT
_CLASS[97:123] = _LETTER
_CLASS[128:] = _LETTER


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def split_pieces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the pieces of lower-cased bytes of easy characters."""
    kind = _CLASS[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = np.ones(len(data) + 1, dtype=bool)
    begins[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    # An apostrophe of its own takes the endings s, t, m, d, re, ve and ll with it.
    at = np.flatnonzero((data == 39) & begins[:-1])
    at = at[at + 1 < len(data)]
    at = at[kind[at + 1] == _LETTER]
    one, two = data[at + 1], data[np.minimum(at + 2, len(data) - 1)]
    in_text = at + 2 < len(data)
    short = np.isin(one, list(b"stmd"))
    long = in_text & (((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108))
    taken = short | long
    begins[at[taken] + 1] = False
    after = at[taken] + np.where(short[taken], 2, 3)
    begins[after[after < len(data)]] = True
    edges = np.flatnonzero(begins)
    starts, ends = edges[:-1], edges[1:]
    solid = kind[starts] != _BLANK
    return starts[solid], ends[solid]


class Tokens:
    """Ids of texts; ``spec`` is the JSON text of the tokenizer's file."""

    def __init__(self, spec: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has given this task one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        rules = json.loads(spec)
        self.plain = rules.get("normalizer") == NORMALIZER and rules.get("pre_tokenizer") == PRE_TOKENIZER
        self.specials = [t["content"] for t in rules.get("added_tokens") or []]
        self.letters = _byte_letters()
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)  # hashes of the pieces, sorted
        self.place = np.zeros(0, dtype=np.int64)  # of each, its number in the order of learning
        self.first = np.zeros(1, dtype=np.int64)  # by that number: its first id, and after the last one the end
        self.ids = np.zeros(0, dtype=np.uint32)
        self.words: dict[str, np.ndarray] = {}

    def _model_ids(self, piece: bytes) -> list[int]:
        if not piece.isascii():
            return [t.id for t in self.tokenizer.model.tokenize(piece.decode("latin-1").translate(self.letters))]
        return [t.id for t in self.tokenizer.model.tokenize(piece.decode())]

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        ids = [self._model_ids(p) for p in pieces]
        ends = np.cumsum([len(x) for x in ids], dtype=np.int64)
        self.place = np.concatenate([self.place, len(self.known) + np.arange(len(pieces))])
        self.known = np.concatenate([self.known, hashes])
        order = np.argsort(self.known, kind="stable")
        self.known, self.place = self.known[order], self.place[order]
        self.first = np.concatenate([self.first, self.first[-1] + ends])
        self.ids = np.concatenate([self.ids, *(np.array(x, dtype=np.uint32) for x in ids)])

    def _block(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first id of each piece and the end, first byte of each piece) of easy characters."""
        data = np.frombuffer(text.lower().encode(), dtype=np.uint8)
        starts, ends = split_pieces(data)
        hashes, which = np.unique(piece_hashes(data, starts, ends), return_inverse=True)
        at = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), dtype=bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != hashes[inside]
        if new.any():
            if len(self.known) + new.sum() > MEMORY:
                self.forget()
                new[:] = True
            sample = np.zeros(len(hashes), dtype=np.int64)
            sample[which] = np.arange(len(which))
            raw = data.tobytes()
            self._learn(hashes[new], [raw[starts[i]:ends[i]] for i in sample[new]])
            at = np.searchsorted(self.known, hashes)
        number = self.place[at][which]
        begin = self.first[number]
        count = self.first[number + 1] - begin
        edges = np.concatenate([[0], np.cumsum(count)])
        gather = np.repeat(begin - edges[:-1], count) + np.arange(edges[-1])
        return self.ids[gather], edges, starts

    def _by_words(self, text: str) -> np.ndarray:
        """Any text: the library encodes each distinct run without blanks."""
        words = _BLANKS.split(text)
        new = [w for w in dict.fromkeys(words) if w not in self.words]
        if new:
            if len(self.words) + len(new) > MEMORY // 4:
                self.words.clear()
                new = list(dict.fromkeys(words))
            for w, e in zip(new, self.tokenizer.encode_batch(new, add_special_tokens=False)):
                self.words[w] = np.array(e.ids, dtype=np.uint32)
        return np.concatenate([self.words[w] for w in words])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text, none for null."""
        out: list[np.ndarray | None] = [None] * len(texts)
        group, size = [], 0

        def flush():
            nonlocal group, size
            if not group:
                return
            joined = "\n".join(texts[i] for i in group)
            lengths = [len(texts[i].lower().encode()) + 1 for i in group]
            ids, edges, starts = self._block(joined)
            cuts = edges[np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))]
            for i, a, b in zip(group, cuts[:-1], cuts[1:]):
                out[i] = ids[a:b]
            group, size = [], 0

        for i, text in enumerate(texts):
            if not text:
                out[i] = np.zeros(0, dtype=np.uint32)
            elif not self.plain:
                out[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
            elif not _EASY.fullmatch(text) or any(s in text for s in self.specials):
                out[i] = np.concatenate([self._by_words(part) for part in _parts(text)])
            elif len(text) > BLOCK:
                out[i] = np.concatenate([self._block(part)[0] for part in _parts(text)])
            else:
                if size + len(text) > BLOCK:
                    flush()
                group.append(i)
                size += len(text)
        flush()
        return out


def _parts(text: str):
    """A text in parts of about ``BLOCK`` characters, cut at blanks."""
    at = 0
    while at < len(text):
        end = at + BLOCK
        if end < len(text):
            blank = _BLANKS.search(text, end)
            end = blank.end() if blank else len(text)
        yield text[at:end]
        at = end


_worker: dict[int, Tokens] = {}


def worker_tokens(spec: str) -> Tokens:
    """This worker's tokenizer, which keeps what it has learned from task to task."""
    key = hash(spec)
    if key not in _worker:
        _worker.clear()
        _worker[key] = Tokens(spec)
    return _worker[key]
