"""Byte-level BPE by merge ranks: encoding with a rank queue, and decoding.

A pre-token (a match of the pattern) begins as a linked list of its bytes. The queue has a bucket for each
merge rank, with the list positions where a pair of that rank begins, and a two-level bitmap of the buckets
in use; find-first-set gives the lowest rank (in a bucket the first position comes first). Entries whose pair has changed meanwhile are stale and are
skipped. So a pre-token of n bytes takes about n queue steps however long it is.

Texts are encoded whole, each where it lies: no shuffle. Pre-tokens repeat, so each Python worker keeps the
ids of those it has met, up to a fixed number. Those that are new in some texts go through one queue together: pre-tokens
do not change each other, and a bucket then serves all that have a pair of its rank.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from stakescore.llm.word_ids import PLAIN_WORD, Memory

#: Fixed value: the pattern for which a single space before a visible character always begins a match.
SPACED = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Ranks in one word of the lower bitmap.
WORD_BITS = 8
WORD = (1 << WORD_BITS) - 1
NO_RANK = -1
#: Characters of the texts whose new pre-tokens are found together (of one text at least).
TEXTS_AT_ONCE = 1 << 18
#: Bytes of the pre-tokens in one queue (of one pre-token at least).
QUEUED_AT_ONCE = 1 << 13


class ByteBpe:
    """Encoder and decoder of one rank file (lines of base64 token and rank)."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.byte_ids = [self.ranks.get(bytes([b])) for b in range(256)]
        self.byte_pairs = np.full(1 << 16, NO_RANK, np.int32)  # rank of two bytes
        for token, rank in self.ranks.items():
            if len(token) == 2:
                self.byte_pairs[token[0] << 8 | token[1]] = rank
        self.matches = regex.compile(pattern).findall
        self.spaced = pattern == SPACED
        self._pieces = Memory(self._piece)
        self._first = Memory(self._chunk)
        self._later = Memory(self._later_chunk)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each pre-token: as long as it has a pair with a rank, the first of the lowest is merged."""
        find = self.ranks.get
        joined = b"".join(pieces)
        size = len(joined)
        if not size:  # a pattern may match nothing
            return [b""] * len(pieces)
        bounds = np.cumsum([0, *map(len, pieces)])
        begins = bytearray(size + 1)  # where pre-tokens begin, and the end
        np.frombuffer(begins, np.uint8)[bounds] = 1
        ids, alive = list(map(self.byte_ids.__getitem__, joined)), bytearray(b"\1") * size
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))  # the list: where neighbours begin
        codes = np.frombuffer(joined, np.uint8).astype(np.int32)
        found = np.full(size, NO_RANK, np.int32)
        found[:-1] = self.byte_pairs[codes[:-1] << 8 | codes[1:]]
        found[bounds[1:] - 1] = NO_RANK
        pair = found.tolist()  # rank of the pair that begins here
        buckets, words, top = _queue(found)
        fresh: list[int] = []  # where pairs begin whose rank has no bucket yet
        while top:
            word = (top & -top).bit_length() - 1  # find first set
            rank = (word << WORD_BITS) + (words[word] & -words[word]).bit_length() - 1
            bucket = buckets[rank]
            lowest = rank
            while bucket and lowest == rank:
                i = heappop(bucket)
                if pair[i] != rank:
                    continue  # stale
                ids[i] = rank
                gone = after[i]
                end = after[i] = after[gone]
                alive[gone] = 0
                pair[gone] = pair[i] = NO_RANK
                if not begins[end]:
                    before[end] = i
                    pair[i] = new = find(joined[i : after[end]], NO_RANK)
                    if new in buckets:
                        heappush(buckets[new], i)
                    elif new != NO_RANK:
                        fresh.append(i)
                if not begins[i]:
                    ahead = before[i]
                    pair[ahead] = new = find(joined[ahead:end], NO_RANK)
                    if new in buckets:
                        heappush(buckets[new], ahead)
                    elif new != NO_RANK:
                        fresh.append(ahead)
                while fresh:
                    i = fresh.pop()
                    new = pair[i]
                    if new in buckets:  # both are of one rank
                        heappush(buckets[new], i)
                        continue
                    buckets[new] = [i]
                    upper = new >> WORD_BITS
                    words[upper] = words.get(upper, 0) | 1 << (new & WORD)
                    top |= 1 << upper
                    if new < lowest:
                        lowest = new
            if not bucket:
                del buckets[rank]
                words[word] ^= 1 << (rank & WORD)
                if not words[word]:
                    top ^= 1 << word
        packed = np.array(list(compress(ids, alive)), "<u4").tobytes()
        ends = (4 * np.concatenate([[0], np.cumsum(np.frombuffer(alive, np.uint8), dtype=np.int64)])[bounds]).tolist()
        return [packed[a:b] for a, b in zip(ends, ends[1:])]

    def _learn(self, pieces: list[str]) -> list[bytes]:
        """Ids of pre-tokens: those without an id of their own go through the queue."""
        spelled = [piece.encode() for piece in pieces]
        ids: list[bytes | None] = []
        for whole in map(self.ranks.get, spelled):
            ids.append(None if whole is None else whole.to_bytes(4, "little"))
        queued: list[int] = []
        size = 0
        for at, whole in enumerate(ids):
            if whole is None:
                queued.append(at)
                size += len(spelled[at])
            if queued and (size >= QUEUED_AT_ONCE or at == len(ids) - 1):
                for i, merged in zip(queued, self.merge([spelled[i] for i in queued])):
                    ids[i] = merged
                queued, size = [], 0
        return ids

    def _piece(self, piece: str) -> bytes:
        return self._learn([piece])[0]

    def _chunk(self, chunk: str) -> bytes:
        return b"".join(map(self._pieces.__getitem__, self.matches(chunk)))

    def _parts(self, chunk: str) -> list[str]:
        """The matches in a later chunk and the white space before it."""
        space, word = ("", chunk[1:]) if chunk.startswith("\n") else (" ", chunk)
        plain = PLAIN_WORD(word)  # whose matches are the letters and the mark
        parts = [space + plain[1], *plain[2]] if plain else self.matches(space + word)
        return parts if space else ["\n", *parts]

    def _later_chunk(self, chunk: str) -> bytes:
        return b"".join(map(self._pieces.__getitem__, self._parts(chunk)))

    def _learn_chunks(self, chunks: Iterable[str]) -> None:
        """Remember the ids of later chunks; the pre-tokens that are new in them go through the queue together."""
        new = self._later.unknown(chunks)
        parts = list(map(self._parts, new))
        pieces = self._pieces.unknown(chain.from_iterable(parts))
        for piece, ids in zip(pieces, self._learn(pieces)):
            self._pieces.keep(piece, ids)
        for chunk, matches in zip(new, parts):
            self._later.keep(chunk, b"".join(map(self._pieces.__getitem__, matches)))

    def _cut(self, text: str | None) -> tuple[bytes, list[str]]:
        """The ids of a text's first chunk, and its later chunks."""
        if not text:
            return b"", []
        if not self.spaced or " ".join(text.split()) != text.replace("\n", " "):
            return self._chunk(text), []
        first, *later = text.replace("\n", " \n").split(" ")
        return self._first[first], later

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of whole texts as little-endian 32-bit numbers; none for null.

        By the pattern ``SPACED`` a single space between two visible characters always begins a match, and a line feed is
        one, so a text whose white space is of that kind is encoded chunk by chunk; by others texts are matched whole.
        """
        for some in _together(texts):
            cut = list(map(self._cut, some))
            self._learn_chunks(chain.from_iterable(later for _, later in cut))
            for first, later in cut:
                yield first + b"".join(map(self._later.__getitem__, later))

    def encode(self, text: str | None) -> bytes:
        """The ids of one text, as :meth:`encode_all` gives them."""
        return next(self.encode_all([text]))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _queue(pairs: np.ndarray) -> tuple[dict[int, list[int]], dict[int, int], int]:
    """Positions by rank (each list a heap, as it ascends), and the lower and the upper bitmap."""
    order = np.argsort(pairs, kind="stable")
    order = order[np.searchsorted(pairs[order], 0) :]
    used, starts = np.unique(pairs[order], return_index=True)
    positions, bounds = order.tolist(), [*starts.tolist(), len(order)]
    buckets = {rank: positions[a:b] for rank, a, b in zip(used.tolist(), bounds, bounds[1:])}
    words: dict[int, int] = {}  # ranks in use
    top = 0  # words in use
    for rank in buckets:
        word = rank >> WORD_BITS
        words[word] = words.get(word, 0) | 1 << (rank & WORD)
        top |= 1 << word
    return buckets, words, top


def _together(texts: Iterable[str | None]) -> Iterator[list[str | None]]:
    """The texts in groups of about ``TEXTS_AT_ONCE`` characters."""
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text or "")
        if size >= TEXTS_AT_ONCE:
            yield some
            some, size = [], 0
    if some:
        yield some


@lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """One coder for each worker and vocabulary."""
    return ByteBpe(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens and ids (little-endian 32-bit numbers). A null text has no ids."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(path, pattern)
        for batch in batches:
            ids = list(coder.encode_all(batch.column(1).to_pylist()))
            yield pa.record_batch({
                "doc_id": batch.column(0), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                "ids": pa.array(ids, pa.binary()),
            })

    return docs.select(F.col(doc_id).cast("bigint"), text).mapInArrow(rows, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document of :func:`encode`: doc_id and text, the decoded bytes as UTF-8."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(path, pattern)
        for batch in batches:
            yield pa.record_batch({
                "doc_id": batch.column(0),
                "text": pa.array([None if x is None else coder.decode(x).decode(errors="replace") for x in batch.column(1).to_pylist()], pa.string()),
            })

    return encoded.select("doc_id", "ids").mapInArrow(rows, "doc_id long, text string")


def digests(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, SHA-256 of its ids and of the bytes they decode to, in one pass.

    A null text is an empty one; rows of equal doc_id stay apart; other columns are not read.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(path, pattern)
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for ids in coder.encode_all(batch.column(1).to_pylist()):
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_bytes.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            yield pa.record_batch({
                "doc_id": batch.column(0), "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(of_ids, pa.string()), "decoded_sha256": pa.array(of_bytes, pa.string()),
            })

    return docs.select(F.col(doc_id).cast("bigint"), text).mapInArrow(
        rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
