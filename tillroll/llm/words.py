"""Tokenizers behind a cache of words, for tasks that encode many texts.

A byte-level or word-end BPE splits a text before it merges, so the tokens of a word do not
depend on its neighbours. Each worker asks the library's model for a word once and keeps the
answer. Only visible ASCII and Latin-1 letters are split here; other words, special strings
and irregular spacing go through the library's own splitting, and so does every text if the
tokenizer's file says anything else than what is assumed here.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from functools import cache

import numpy as np
from tokenizers import Tokenizer

#: Words in a worker's memory. A word takes some 200 bytes.
CACHE_WORDS = 1 << 20

# Letters that are split here, and the splitting patterns of the tokenizers.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_REGULAR = re.compile(rf"[\x20-\x7e{_LETTERS}]*")
_WORD = re.compile(rf"[{_LETTERS}]+")
_SIGNS = frozenset(".,;:!?")
_BYTE_LEVEL = re.compile(
    rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s0-9{_LETTERS}]+"
)
_WORD_END = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{_LETTERS}]+|[0-9]|[^\s0-9{_LETTERS}]+")

# What a tokenizer's file has to say for its words to be split here.
_MODEL = {
    "type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
    "fuse_unk": False, "byte_fallback": False, "ignore_merges": False,
}
_BYTE_LEVEL_FILE = {
    "normalizer": None,
    "pre_tokenizer": {
        "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True,
    },
    "model": _MODEL | {"end_of_word_suffix": None},
}
_WORD_END_FILE = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "model": _MODEL | {"end_of_word_suffix": "</w>"},
}


# The bytes that byte-level vocabularies show as themselves; the others follow
# from U+0100 on.
def _visible_bytes() -> dict[int, str]:
    """The visible character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others follow from U+0100 on.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(others)}


_VISIBLE = _visible_bytes()
_SPACE = _VISIBLE[0x20]


def _pieces(model, token: str) -> list[int]:
    """Ids of a single token of the splitting pattern."""
    if token[0] == " " and token.isascii() and token[1:].isalpha():
        token = _SPACE + token[1:]
    elif not token.isascii():
        token = token.encode().decode("latin-1").translate(_VISIBLE)
    elif not token.isalpha():
        token = token.translate(_VISIBLE)
    return [piece.id for piece in model.tokenize(token)]


@cache
def library(path: str) -> Tokenizer:
    """The tokenizer of a file, once in each Python worker."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@cache
def _is_as(path: str, kind: str) -> bool:
    """Whether a tokenizer's file has the settings of a kind: ``byte_level`` or ``word_end``.

    Special strings have to be marked by ``<|``, which is looked for in words.
    """
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    wanted = {"byte_level": _BYTE_LEVEL_FILE, "word_end": _WORD_END_FILE}[kind]
    model = {name: found["model"].get(name) for name in wanted["model"]}
    return (
        {**found, "model": model}.items() >= wanted.items()
        and all(x["content"].startswith("<|") for x in found.get("added_tokens") or ())
    )


def version(path: str) -> str:
    """Digest of a tokenizer's file."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class _Memory(dict):
    """A dict that computes missing values and keeps the first that it is asked for.

    When it is full it stays as it is, as frequent words come early, until as many others as it
    holds have been computed; then it forgets all.
    """

    def __init__(self):
        super().__init__()
        self._others = 0

    def __missing__(self, key):
        found = self.compute(key)
        if len(self) < CACHE_WORDS:
            self[key] = found
            return found
        self._others += 1
        if self._others >= CACHE_WORDS:
            self.clear()
            self._others = 0
        return found

    def compute(self, key):
        raise NotImplementedError


class _Irregular(Exception):
    """A text that has to be encoded as a whole."""


class _Tokens(_Memory):
    """Packed ids by token of the byte-level splitting pattern."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self._model = tokenizer.model

    def compute(self, key: str) -> bytes:
        return _packed(_pieces(self._model, key))


class _Words(_Memory):
    """Packed ids by word, a word being what stands between two single spaces of a line.

    Every space before a visible character starts a token, so the word is encoded with that
    space in front; the letters of a word with signs are looked up as a word. White space at a
    word's ends (doubled spaces) and special strings make the text irregular.
    """

    space = " "

    def __init__(self, tokenizer: Tokenizer, tokens: _Tokens):
        super().__init__()
        self._tokenizer, self._tokens = tokenizer, tokens

    def compute(self, key: str) -> bytes:
        if _WORD.fullmatch(key):
            return _packed(_pieces(self._tokens._model, self.space + key))
        # a sign behind a letter is a token of its own
        if key[-1:] in _SIGNS and key[-2:-1].isalpha():
            return self[key[:-1]] + self._tokens[key[-1]]
        if not key or key[0].isspace() or key[-1].isspace() or "<|" in key or "|>" in key:
            raise _Irregular
        if _REGULAR.fullmatch(key):
            return b"".join(map(self._token, _BYTE_LEVEL.findall(self.space + key)))
        found = self._tokenizer.encode(self.space + key, add_special_tokens=False).ids
        return _packed(found)

    def _token(self, token: str) -> bytes:
        if token[0] == " " and _WORD.fullmatch(token, 1):
            return self[token[1:]]
        return self._tokens[token]


class _Openings(_Words):
    """The same for the first words of lines, which have no space in front."""

    space = ""


class ByteLevelIds:
    """Ids of whole texts by a byte-level BPE, exactly as the library gives them."""

    def __init__(self, path: str):
        self._tokenizer = library(path)
        self._known = _is_as(path, "byte_level")
        self._tokens = _Tokens(self._tokenizer)
        self._words = _Words(self._tokenizer, self._tokens)
        self._openings = _Openings(self._tokenizer, self._tokens)

    def of(self, text: str | None) -> np.ndarray:
        """Unsigned 32-bit ids; none for null and empty texts."""
        if not text:
            return np.zeros(0, "<u4")
        # line breaks are tokens of one each if no more than two follow each other, and one ends the text
        if self._known and "\n\n\n" not in text and text[-2:] != "\n\n":
            try:
                return np.frombuffer(b"".join(self._packed(text)), "<u4")
            except _Irregular:
                pass
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _packed(self, text: str) -> list[bytes]:
        found: list[bytes] = []
        end = self._tokens["\n"]
        for line in text.split("\n"):
            if line:
                first, *later = line.split(" ")
                found.append(self._openings[first])
                found += map(self._words.__getitem__, later)
            found.append(end)
        found.pop()
        return found


class _Counts(_Memory):
    """Numbers of tokens by word, a word being what stands between spaces or line breaks."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self._tokenizer, self._model = tokenizer, tokenizer.model

    def compute(self, key: str) -> int:
        if not key:
            return 0
        if _WORD.fullmatch(key):
            return len(_pieces(self._model, key.lower()))
        if _REGULAR.fullmatch(key) and "<|" not in key:
            return sum(map(self._token, _WORD_END.findall(key.lower())))
        return len(self._tokenizer.encode(key, add_special_tokens=False).ids)

    def _token(self, token: str) -> int:
        if _WORD.fullmatch(token):
            return self[token]
        return len(_pieces(self._model, token))


class WordCounts:
    """Numbers of tokens of whole texts by a lower-casing BPE whose tokens hold no white space."""

    def __init__(self, path: str):
        self._tokenizer = library(path)
        self._known = _is_as(path, "word_end")
        self._counts = _Counts(self._tokenizer)

    def of(self, text: str | None) -> int:
        if not text:
            return 0
        if not self._known:
            return len(self._tokenizer.encode(text, add_special_tokens=False).ids)
        return sum(map(self._counts.__getitem__, text.replace("\n", " ").split(" ")))


@cache
def byte_level_ids(path: str) -> ByteLevelIds:
    """One memory of words for all tasks of a Python worker."""
    return ByteLevelIds(path)
