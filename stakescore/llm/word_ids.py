"""Token ids of whole texts by a word-level BPE of the ``tokenizers`` library.

Where white space always ends a token, a text's ids are those of its white-space chunks in order. Chunks repeat, so each
Python worker keeps the ids of the chunks it has met, up to a fixed number. That, and how chunks of Latin letters are
taken apart here, holds for one normalizer and one splitter; a vocabulary file with others is left to the library, text by text.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from stakescore.llm.batches import batches_of
from stakescore.llm.kept import kept

#: Texts encoded at once.
AT_ONCE = 1024
#: Chunks, and words, that a worker keeps at hand (and as many older ones); it forgets the rest, which costs time only.
REMEMBERED = 400_000
#: Longer chunks are encoded each time.
LONGEST_REMEMBERED = 48

#: Letters that lower case and normal form C map one by one, with at most one mark behind them.
PLAIN_WORD = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)").fullmatch
LETTERS = re.compile("[a-zß-öø-ÿ]+").fullmatch
#: The splitter of ``KNOWN`` for lower-case Latin-1 text without white space.
SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^a-z0-9ªµºß-öø-ÿ²³¹¼-¾]+").findall
#: A mark that may belong to the one before it.
CROWDED_MARK = re.compile("[^a-z0-9ß-öø-ÿ\\s][.,]").search
#: Where a mark ends a word, and the same with the mark apart.
MARKS = [(f"{mark}{space}", f" {mark}{space}") for mark in ".," for space in " \n"]
#: The settings, as a vocabulary file names them, for which chunks may be encoded alone.
KNOWN = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"},
    ]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
    "post_processor": None, "truncation": None, "padding": None,
}
#: White space for Python only, or for the tokenizer only.
DISPUTED_SPACE = re.compile("[\x1c-\x1f]").search


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Memory(dict):
    """Ids by chunk; what is missing is made when asked for.

    When full, the memory becomes the old one, from which chunks come back as they are met again.
    """

    def __init__(self, make):
        super().__init__()
        self.make = make
        self.old: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
            if len(key) > LONGEST_REMEMBERED:
                return value
        self.keep(key, value)
        return value

    def keep(self, key: str, value: bytes) -> None:
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[key] = value

    def unknown(self, keys: Iterable[str]) -> list[str]:
        """Those of the keys, once each, that would have to be made and then be kept."""
        return [k for k in dict.fromkeys(keys) if k not in self and k not in self.old and len(k) <= LONGEST_REMEMBERED]


class WordEncoder:
    """Little-endian ids of texts, 2 bytes each if the vocabulary allows, else 4."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.size = size
        self._typecode = next(c for c in "HIL" if array(c).itemsize == self.dtype.itemsize)
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        # Added tokens are found before anything is split; a text with the mark they begin with goes to the library.
        added = all(t["content"].startswith("<|") and not t["normalized"] for t in settings.get("added_tokens", []))
        self.known = added and all(settings.get(k) == v for k, v in KNOWN.items())
        self._bytes = byte_characters()
        self._tokenize = self.tokenizer.model.tokenize
        self._words = Memory(self._word)
        self._pieces = Memory(self._piece)
        self._chunks = Memory(self._whole)

    def _pack(self, ids: list[int]) -> bytes:
        packed = array(self._typecode, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _whole(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        """A match of the splitter in a text in lower case."""
        plain = piece.isascii() and piece.isprintable()
        spelled = piece if plain else piece.encode().decode("latin-1").translate(self._bytes)
        return self._pack([t.id for t in self._tokenize(spelled)])

    def _word(self, word: str) -> bytes:
        """A chunk of a text in lower case."""
        if LETTERS(word):
            return self._piece(word)
        return b"".join(map(self._pieces.__getitem__, SPLIT(word)))

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text; those of null are none.

        In a text of Latin letters words are looked up in lower case and without the mark behind them.
        """
        if not text:
            return b""
        if not self.known or DISPUTED_SPACE(text):
            return self._whole(text)
        if "<|" not in text and _latin(text):
            lower = text.lower() + " "
            if not CROWDED_MARK(lower):
                for joined, apart in MARKS:
                    lower = lower.replace(joined, apart)
                return b"".join(map(self._words.__getitem__, lower.split()))
        return b"".join(map(self._chunks.__getitem__, text.split()))


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@kept
def word_encoder(path: str) -> WordEncoder:
    """One encoder for each worker and vocabulary."""
    return WordEncoder(path)


def encoded(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Each batch with the ids of its second column's texts, ``end_id`` behind each."""
    encoder = word_encoder(path)
    end = np.array([end_id], encoder.dtype).tobytes()
    for batch in batches_of(batches, AT_ONCE):
        yield batch, [np.frombuffer(encoder.encode(t) + end, encoder.dtype) for t in batch.column(1).to_pylist()]
