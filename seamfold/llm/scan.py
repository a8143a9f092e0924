"""Words of whole Arrow columns at once: where they are, what they hash to, which stand side by side."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from seamfold.llm.core import mix

#: Bytes that are looked at together; a longer text is looked at alone.
CHUNK = 1 << 21
#: Bytes of a word whose hashes come from a table; later ones are computed.
_TABLED = 32
WORD, SPACE, BREAK = 0, 1, 2


class Scanner:
    """Splits UTF-8 texts into words by classes of bytes, and hashes them.

    space and breaks: bytes between words, and those between pieces. A word's hash is the
    sum of a random number for each of its bytes and their places, mixed with its length
    and with what its text belongs to; another seed gives other numbers.
    """

    def __init__(self, space: bytes, breaks: bytes = b"", lower: bool = True, seed: int = 0) -> None:
        self.kind = np.zeros(256, np.uint8)
        self.kind[list(space)], self.kind[list(breaks)] = SPACE, BREAK
        self.low = np.arange(256, dtype=np.uint8)
        if lower:
            self.low[ord("A") : ord("Z") + 1] += 32
        self.seed = np.uint64(seed)
        self.table = self._numbers(np.arange(_TABLED * 256))

    def _numbers(self, place: np.ndarray) -> np.ndarray:
        return mix(place.astype(np.uint64) + np.uint64(1) + (self.seed << np.uint64(40)))

    def hashes(self, raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Of stretches of raw, sums over their bytes; not mixed yet. The lengths are positive."""
        if not len(starts):
            return np.zeros(0, np.uint64)
        first = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum()), dtype=np.int32) - np.repeat(first.astype(np.int32), lengths)
        byte = raw[place + np.repeat(starts.astype(np.int32), lengths)]
        number = self.table[np.minimum(place, _TABLED - 1) * 256 + byte]
        late = np.flatnonzero(place >= _TABLED)
        number[late] = self._numbers(place[late].astype(np.int64) * 256 + byte[late])
        return np.add.reduceat(number, first)

    def finish(self, sums: np.ndarray, lengths: np.ndarray, salt: np.ndarray | int = 0) -> np.ndarray:
        """Word hashes, never 0; salt: what a word's text belongs to, as a 64-bit number."""
        out = mix(sums + mix(lengths.astype(np.uint64) + np.asarray(salt, np.uint64)))
        return np.where(out == 0, np.uint64(1), out)

    def chunks(self, texts: pa.Array) -> Iterator[Words]:
        """The words of a text column, some documents at a time, every document once; null texts have none."""
        texts = texts.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        a = 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + CHUNK, side="right")) - 1)
            yield Words(self, raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], a)
            a = b


class Words:
    """The words of some documents that follow each other in a column, the first of them at place `first`.

    starts, lengths: of each word in raw, the documents' bytes in lower case; doc: whose it
    is, counted from the chunk's first; beside: whether a word's next one is of the same piece.
    """

    def __init__(self, scanner: Scanner, raw: np.ndarray, offsets: np.ndarray, first: int) -> None:
        self.first, self.n_docs, self.scanner, self.offsets = first, len(offsets) - 1, scanner, offsets
        kind, self.raw = scanner.kind[raw], scanner.low[raw]
        word = kind == WORD
        edge = offsets[:-1][np.diff(offsets) > 0]
        begin = word.copy()
        begin[1:] &= ~word[:-1]
        begin[edge[word[edge]]] = True
        self.starts = np.flatnonzero(begin)
        stop = np.zeros(len(word), bool)
        stop[:-1] = word[:-1] & (~word[1:] | begin[1:])
        stop[-1:] = word[-1:]
        self.lengths = np.flatnonzero(stop) + 1 - self.starts
        self.doc = np.searchsorted(offsets, self.starts, side="right") - 1
        piece = np.cumsum(kind == BREAK, dtype=np.int32)[self.starts]
        self.beside = np.zeros(len(self.starts), bool)
        self.beside[:-1] = (piece[1:] == piece[:-1]) & (self.doc[1:] == self.doc[:-1])

    def hashes(self, salt: np.ndarray | int = 0) -> np.ndarray:
        return self.scanner.finish(self.scanner.hashes(self.raw, self.starts, self.lengths), self.lengths, salt)

    def counts(self) -> np.ndarray:
        """Words of each document."""
        return np.bincount(self.doc, minlength=self.n_docs)

    def spelled(self, at: np.ndarray) -> list[bytes]:
        raw = self.raw.tobytes()
        return [raw[a : a + n] for a, n in zip(self.starts[at].tolist(), self.lengths[at].tolist(), strict=True)]
