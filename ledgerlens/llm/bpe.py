"""Byte-level BPE by backtracking over longest matches.

A pretoken's bytes are mapped one to one to Latin-1 characters, so that an
Aho-Corasick automaton over strings finds vocabulary entries in bytes. The
encoder takes the longest entry at a place, steps back to shorter ones when
it doesn't fit its left neighbour, and drops the neighbour when none fits.
Two adjacent entries fit when merging their joined bytes by ranks gives the
two back; that is decided once a pair and kept. A sequence whose adjacent
pairs all fit is the one the merges give, and since a place from which no
sequence goes on is marked and not tried again, the work is linear in the
bytes.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex

from pyspark.sql import DataFrame

from .common import map_batches, text_slices, whole_text
from .vocabulary import UnitMemo, no_collection, vocabulary_path

DEFAULT_RANKS = "byte_bpe_50k.tiktoken"
#: Pairs kept in a worker's memo; it starts anew when full.
MEMO_PAIRS = 200_000
#: Bytes of a pretoken that are matched ahead at once.
MATCH_WINDOW = 1 << 16


def read_ranks(vocabulary: str) -> dict[bytes, int]:
    with open(vocabulary_path(vocabulary), "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_parts(piece: bytes, ranks: dict[bytes, int], down_to: int = 1) -> list[bytes]:
    """The defining procedure: join the adjacent pair of least rank, leftmost
    first, until no pair is in the vocabulary or ``down_to`` parts are left."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > down_to:
        best = min(range(len(parts) - 1),
                   key=lambda i: ranks.get(parts[i] + parts[i + 1], len(ranks)))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best:best + 2] = [parts[best] + parts[best + 1]]
    return parts


def merge_by_ranks(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    return [ranks[part] for part in merge_parts(piece, ranks)]


class BacktrackingEncoder:
    """Ids of bytes by the ranks of a vocabulary that holds every byte."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.token = [b""] * self.size
        for token, rank in ranks.items():
            self.token[rank] = token
        self._length = list(map(len, self.token))
        self._longest_token = max(self._length)
        self._automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self._automaton.add_word(token.decode("latin-1"), rank)
        self._automaton.make_automaton()
        self._made_of: dict[int, tuple[int, int] | None] = {}
        self._shorter: dict[int, int] = {}
        self._fits: dict[int, bool] = {}  # by left * size + right

    def _next_shorter(self, token: int) -> int:
        """The longest entry that is a proper prefix of ``token``; -1: none."""
        found = self._shorter.get(token)
        if found is None:
            text = self.token[token]
            found = next((self.ranks[text[:n]] for n in range(len(text) - 1, 0, -1)
                          if text[:n] in self.ranks), -1)
            self._shorter[token] = found
        return found

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two entries whose merge makes ``token``; None: a single byte, or
        an entry that merges of its own bytes never give."""
        if token not in self._made_of:
            text = self.token[token]
            parts = merge_parts(text, self.ranks, down_to=2)
            self._made_of[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if (
                len(parts) == 2) else None
        return self._made_of[token]

    def _compatible(self, left: int, right: int) -> bool:
        """Can ``right`` follow ``left`` (-1: stand first)?"""
        if len(self._fits) > MEMO_PAIRS:
            self._fits.clear()
        made = len(self.token[right]) == 1 or self._halves(right) is not None
        found = self._fits[left * self.size + right] = made and (left < 0 or self._stay_apart(left, right))
        return found

    def _stay_apart(self, left: int, right: int) -> bool:
        """Would merging the joined bytes leave the two entries as they are?

        Goes back in time: ranks are the order of merges, so the entry of
        larger rank was made last (of equal ones the right). Before it was
        made, its inner half touched the border. A merge across the border
        that comes before the next event there would have been made.
        """
        ranks, token, until = self.ranks, self.token, self.size
        while True:
            across = ranks.get(token[left] + token[right])
            if across is not None and across < until:
                return False
            left_halves, right_halves = self._halves(left), self._halves(right)
            if left_halves and (left > right or not right_halves):
                until, left = left, left_halves[1]
            elif right_halves:
                until, right = right + 1, right_halves[0]
            else:
                return True

    def _longest_matches(self, text: str, start: int) -> array:
        """For each place of a window from ``start``, the longest entry there."""
        end = min(len(text), start + MATCH_WINDOW)
        longest, length = array("i", [-1]) * (end - start), self._length
        reach = min(len(text), end + self._longest_token - 1)
        for last, rank in self._automaton.iter(text, start, reach):
            first = last - length[rank] + 1
            if first < end:  # a later end is a longer match
                longest[first - start] = rank
        return longest

    def encode(self, piece: bytes) -> list[int]:
        if not piece:
            return []
        text, size, fits, length = piece.decode("latin-1"), len(piece), self._fits, self._length
        vocabulary = self.size
        open_ends = bytearray(b"\x01") * (size + 1)  # 0: nothing goes on from there
        window, base = self._longest_matches(text, 0), 0
        out: list[int] = []
        at, left, candidate = 0, -1, window[0]
        while at < size:
            while candidate >= 0:
                end = at + length[candidate]
                if open_ends[end]:
                    fit = fits.get(left * vocabulary + candidate)
                    if fit or fit is None and self._compatible(left, candidate):
                        break
                candidate = self._next_shorter(candidate)
            if candidate >= 0:
                out.append(candidate)
                at, left = end, candidate
                if at < size:
                    if not base <= at < base + len(window):
                        base = at
                        window = self._longest_matches(text, base)
                    candidate = window[at - base]
            else:  # no entry fits here: give the left neighbour up
                open_ends[at] = 0
                candidate = self._next_shorter(out.pop())
                at -= length[left]
                left = out[-1] if out else -1
        return out


class TextCodec:
    """Encodes and decodes whole texts; every pretoken is encoded by itself."""

    def __init__(self, vocabulary: str = DEFAULT_RANKS, pattern: str | None = None):
        from public_tokenizers import PATTERN

        self._encoder = BacktrackingEncoder(read_ranks(vocabulary))
        self._bytes = self._encoder.token
        self._own = regex.compile(pattern) if pattern not in (None, PATTERN) else None
        self._memo = UnitMemo(self._pretoken_ids, PATTERN)

    def _pretoken_ids(self, pretoken: str) -> bytes:
        return array("I", self._encoder.encode(pretoken.encode())).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as unsigned 32-bit integers (little-endian, as all Spark hosts are)."""
        if self._own is not None:  # another pattern: no cut is known beforehand
            return b"".join(map(self._pretoken_ids, self._own.findall(text)))
        with no_collection():
            return self._memo.encode(text)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self._bytes.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_CODECS: dict[tuple, TextCodec] = {}


def codec(vocabulary: str = DEFAULT_RANKS, pattern: str | None = None) -> TextCodec:
    """The worker's codec: made once, kept while the worker lives."""
    if (vocabulary, pattern) not in _CODECS:
        _CODECS[vocabulary, pattern] = TextCodec(vocabulary, pattern)
    return _CODECS[vocabulary, pattern]


def encode_documents(docs: DataFrame, vocabulary: str = DEFAULT_RANKS,
                     pattern: str | None = None) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers) of every row of
    ``docs`` (columns doc_id and text; others ignored). A null or empty text
    has no ids; a null doc_id and repeated rows are kept as they are; texts are
    encoded whole; an empty table gives no rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern)
        for batch in batches:
            for at, texts in text_slices(batch):
                yield pa.record_batch(
                    [batch.column(0).slice(at, len(texts)),
                     pa.array([own.encode(t) for t in texts], pa.binary())], ["doc_id", "ids"])
    return map_batches(
        docs.select("doc_id", whole_text().alias("text")), run,
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode_documents(encoded: DataFrame, vocabulary: str = DEFAULT_RANKS) -> DataFrame:
    """doc_id, ids and the decoded bytes of every row of ``encoded``. No ids give no bytes; null
    doc_ids and repeated rows stay; an empty table gives no rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for batch in batches:
            for at, ids in text_slices(batch):
                yield pa.record_batch(
                    [batch.column(0).slice(at, len(ids)), pa.array(ids, pa.binary()),
                     pa.array([own.decode(i) for i in ids], pa.binary())],
                    ["doc_id", "ids", "decoded"])
    return map_batches(
        encoded.select("doc_id", "ids"), run,
        f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, ids binary, decoded binary")
