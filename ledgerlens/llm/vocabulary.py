"""Encoding whole texts with the ``tokenizers`` library at corpus scale.

A byte-level vocabulary cuts a text into pretokens by a public pattern and
encodes each by itself. The pattern always cuts before a blank that a visible
character follows, so a text is first split there into units; a unit's ids
come from a bounded memo, or else from the ids of its pretokens, or else from
the library. The ids are those of the whole text.
"""

from __future__ import annotations

import gc
import json
import os
from array import array
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import regex

#: Vocabulary file of the contracts; a parameter of every operator.
DEFAULT_TOKENIZER = "byte_bpe_50k.json"
#: Units and pretokens in a generation of a worker's memo. When one is full the
#: next begins, and what is not used again while it fills is forgotten.
MEMO_UNITS = 300_000
#: Longer ones are rare and are encoded without being kept.
MEMO_UNIT_CHARS = 64


def vocabulary_path(name: str) -> str:
    """Path of a vocabulary: a file name of ``public_tokenizers``, or a path."""
    import public_tokenizers

    return name if os.sep in name else public_tokenizers.path(name)


def units(text: str) -> list[str]:
    """``text`` cut before every blank that a visible character follows."""
    if not text:
        return []
    parts = text.split(" ")
    if len(parts) == 1:
        return parts
    out = [parts[0]] if parts[0] else []
    for part in parts[1:]:
        if part and not part[0].isspace():
            out.append(" " + part)
        elif out:
            out[-1] += " " + part
        else:
            out.append(" " + part)
    return out


@contextmanager
def no_collection() -> Iterator[None]:
    """Without the cyclic garbage collector: encoding makes no cycles, and a
    collection would walk the whole memo."""
    enabled = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if enabled:
            gc.enable()


#: A blank and the white space after which no unit begins.
_BLANK_THEN_SPACE = [" " + chr(c) for c in range(0x3001) if chr(c).isspace()]
#: Mark of the keys of units that don't begin with a blank and a visible
#: character; the others are kept without their blank, as splitting leaves them.
_PLAIN = "\n"


class UnitMemo(dict):
    """Ids (little-endian unsigned 32-bit integers) of units and pretokens."""

    def __init__(self, encode_pretoken: Callable[[str], bytes], pattern: str):
        super().__init__()
        self._before: dict[str, bytes] = {}  # the generation before
        self._encode = encode_pretoken
        self._pattern = regex.compile(pattern)

    def __missing__(self, key: str) -> bytes:
        ids = self._before.get(key)
        if ids is None:
            ids = self._ids(key[1:] if key[0] == _PLAIN else " " + key)
        if len(key) <= MEMO_UNIT_CHARS:
            if len(self) >= MEMO_UNITS:
                self._before = dict(self)
                self.clear()
            self[key] = ids
        return ids

    def of(self, unit: str) -> bytes:
        blank = unit[0] == " " and len(unit) > 1 and not unit[1].isspace()
        return self[unit[1:] if blank else _PLAIN + unit]

    def _ids(self, unit: str) -> bytes:
        body = unit[1:]
        if unit[0] == " " and body.isalpha():  # one pretoken
            return self._encode(unit)
        if unit[0] == " " and body[-1:] in (".", ",") and body[:-1].isalpha():  # two
            return self.of(unit[:-1]) + self.of(unit[-1])
        pretokens = self._pattern.findall(unit)
        return self._encode(unit) if len(pretokens) == 1 else b"".join(map(self.of, pretokens))

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if text[-1] == " " or any(b in text for b in _BLANK_THEN_SPACE):
            return b"".join(map(self.of, units(text)))
        first, *others = text.split(" ")  # a unit begins at every blank
        head = self.of(first) if first else b""
        return head + b"".join(map(self.__getitem__, others))


def _byte_letters() -> dict[int, str]:
    """The visible character that stands for each byte in a byte-level
    vocabulary: itself where visible, else the next one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class CorpusEncoder:
    """Ids of whole texts; none are put around them. Strings of added tokens in a
    text are those tokens with ``added_tokens``, as in the library, or else
    ordinary text."""

    def __init__(self, tokenizer: str = DEFAULT_TOKENIZER, added_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(vocabulary_path(tokenizer))
        self._library.encode_special_tokens = not added_tokens
        self._added = [t.content for t in self._library.get_added_tokens_decoder().values()
                       ] if added_tokens else []
        self.vocabulary_size = self._library.get_vocab_size()
        self._memo = None
        if self._cuts_by_the_pattern():
            from public_tokenizers import PATTERN

            self._model, self._letters = self._library.model, _byte_letters()
            self._memo = UnitMemo(self._pretoken_ids, PATTERN)

    def _cuts_by_the_pattern(self) -> bool:
        """Is it a plain byte-level BPE, whose pretokens the pattern gives?"""
        parts = json.loads(self._library.to_str())
        cut = parts["pre_tokenizer"] or {}
        return (parts["normalizer"] is None and parts["model"]["type"] == "BPE"
                and cut.get("type") == "ByteLevel" and cut.get("use_regex", False)
                and not cut.get("add_prefix_space", True))

    def _pretoken_ids(self, pretoken: str) -> bytes:
        if pretoken.isascii() and pretoken.isprintable():  # all but the blank are visible
            letters = pretoken.replace(" ", self._letters[32])
        else:
            letters = pretoken.encode().decode("latin-1").translate(self._letters)
        return array("I", [t.id for t in self._model.tokenize(letters)]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if self._memo is not None:
            with no_collection():
                return [self._whole([t])[0] if any(a in t for a in self._added)
                        else self._memo.encode(t) for t in texts]
        return self._whole(texts)

    def _whole(self, texts: list[str]) -> list[bytes]:
        """The same by the library alone."""
        encodings = self._library.encode_batch(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in encodings]


_ENCODERS: dict[tuple[str, bool], CorpusEncoder] = {}


def encoder(tokenizer: str = DEFAULT_TOKENIZER, added_tokens: bool = False) -> CorpusEncoder:
    """The worker's encoder: made once, kept while the worker lives."""
    key = tokenizer, added_tokens
    if key not in _ENCODERS:
        _ENCODERS[key] = CorpusEncoder(tokenizer, added_tokens)
    return _ENCODERS[key]
