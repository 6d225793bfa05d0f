"""Texts as runs of chunks that tokenizers treat apart, each distinct chunk worked on once.

A text is cut before a single space that stands between two characters that are not white
space, before a mark such as a full stop that follows a letter, and before a letter that follows a lone line feed.
Byte-level BPE files with the usual splitting rule always start a token there, and so do piece models
in which no piece reaches over such a place (``crosses`` tells).  A worker remembers what it
found for a chunk, so that most of a corpus costs a look-up by hash.  Looked-up chunks are joined
and compared with the text, so equal hashes of different chunks cannot go unseen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from tokenizers import Tokenizer

from gridlens.llm import kernels as K

REMEMBERED, JOINED_BYTES = 400_000, 3000

Columns = dict[str, np.ndarray]


def objects(values: list) -> np.ndarray:
    """A numpy array that holds the values as Python objects."""
    out = np.empty(len(values), dtype=object)
    out[:] = values
    return out


_MARKS, _ASCII_LETTERS = (np.isin(np.arange(256), np.frombuffer(x, dtype=np.uint8)) for x in (
    b".,;:!?)]}\"", b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))
#: Second bytes of the two-byte characters after 0xC3 that are letters (all but the signs for times and divided by).
_LATIN_LETTERS = np.array([b >= 0x80 and b not in (0x97, 0xB7) for b in range(256)])


def crosses(piece: str) -> bool:
    """Whether a piece (with U+2581 for a space) reaches over a place at which texts are cut."""
    return any(y == "\u2581" != x or x.isalpha() and ord(y) < 128 and _MARKS[ord(y)] or x == "\n" and y.isalpha()
               for x, y in zip(piece, piece[1:]))


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks start in a block of texts (every text that is not empty starts one)."""
    n = len(data)
    start = np.zeros(n + 1, dtype=bool)
    if n > 2:
        at = np.flatnonzero(data[1:-1] == 32) + 1
        at = at[(data[at - 1] > 32) & (data[at + 1] > 32) & (data[at - 1] != 127) & (data[at + 1] != 127)]
        at = at[~_wide_space(data, at + 1)]
        for size in (2, 3):
            back = np.maximum(at - size, 0)
            at = at[~((data[at - 1] >= 128) & (data[back] >= 0xC0) & _wide_space(data, back))]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        start[at[~edge[at + 1]]] = True
        at = np.flatnonzero(_MARKS[data[2:]]) + 2
        start[at[_ASCII_LETTERS[data[at - 1]] | (data[at - 2] == 0xC3) & _LATIN_LETTERS[data[at - 1]]]] = True
        at = np.flatnonzero((data[1:-1] == 10) & (data[:-2] > 32) & (data[:-2] < 127)) + 2
        at = at[at < n - 1]
        start[at[_ASCII_LETTERS[data[at]] | (data[at] == 0xC3) & _LATIN_LETTERS[data[at + 1]]]] = True
        start[offsets] = False
    start[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(start)


def _wide_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a white-space character beyond ASCII starts at each place (or one that looks like it)."""
    last = len(data) - 1
    a, b, c = data[at], data[np.minimum(at + 1, last)], data[np.minimum(at + 2, last)]
    general = (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F)
    return ((a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & (b == 0x9A) | (a == 0xE2) & general
            | (a == 0xE3) & (b == 0x80) & (c == 0x80))


#: Stands before a chunk that does not start with a space; both kinds of tokenizers end a token with it.
LEAD, GLUE = b" a\n", b"\n"


def _solid(chunk: bytes) -> bool:
    """Whether neither end of the chunk (behind its first space) is white space or a control character."""
    first = chunk[0] == 32
    if len(chunk) > first and 32 < chunk[first] < 127 and 32 < chunk[-1] < 127:
        return True
    text = chunk.decode()
    return len(text) > first and all(c > " " and c != "\x7f" and not c.isspace() for c in (text[first], text[-1]))


def joined(chunks: list[bytes], which: list[int] | None = None) -> Iterator[tuple[bytes, list[int], np.ndarray, np.ndarray]]:
    """Texts of about JOINED_BYTES that start with a space: (text, numbers of the chunks in it, their starts, their ends)."""
    spaced, bare = [], []
    for i in range(len(chunks)) if which is None else which:
        if which is None and _solid(chunks[i]):
            (spaced if chunks[i][0] == 32 else bare).append(i)
        else:
            lead = b"" if chunks[i][0] == 32 else LEAD
            yield lead + chunks[i], [i], np.array([len(lead)]), np.array([len(lead) + len(chunks[i])])
    for group, lead, glue in ((spaced, b"", b""), (bare, LEAD, GLUE)):
        lengths = np.array([len(chunks[i]) + len(glue) for i in group], dtype=np.int64)
        part = np.cumsum(lengths) // JOINED_BYTES
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(group)] if group else [0]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            ends = len(lead) + np.cumsum(lengths[a:b]) - len(glue)
            yield lead + glue.join([chunks[i] for i in group[a:b]]), group[a:b], ends - lengths[a:b] + len(glue), ends


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE files: printable bytes are themselves, others follow U+0100 in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def token_bytes(tokenizer: Tokenizer) -> list[bytes]:
    """What each id of a byte-level BPE file decodes to (added tokens: their own text)."""
    alphabet = byte_alphabet()
    names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    return [bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode() for t in names]


class ChunkMemory:
    """What a worker knows of chunks: ``encode`` gives the columns of new ones, in order."""

    def __init__(self, encode: Callable[[list[bytes]], Columns], limit: int = REMEMBERED):
        self.encode, self.limit = encode, limit
        self.forget()

    def forget(self) -> None:
        self.keys, self.slots, self.uses = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.columns: Columns = {}

    def look(self, data: np.ndarray, offsets: np.ndarray) -> tuple[Columns, np.ndarray, np.ndarray]:
        """(columns, row of them for each chunk, first chunk of each text) of a block of texts."""
        starts = chunk_starts(data, offsets)
        first, ends, raw = np.searchsorted(starts, offsets), np.append(starts[1:], len(data)), data.tobytes()
        if not len(starts):
            return self.columns or {"text": objects([]), **self.encode([])}, np.zeros(0, np.int64), first
        hashes = K.mix(K.window_hash(K.prefix_sums(data), starts, ends))
        keys, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        self._learn(keys, [starts[at], ends[at]], raw)
        mine = self.slots[np.searchsorted(self.keys, keys)]
        self.uses[mine] += 1
        rows, columns = mine[which], self.columns
        if b"".join(columns["text"][rows].tolist()) != raw:  # two chunks with one hash: this block goes by the chunks themselves
            parts = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            place = {c: i for i, c in enumerate(dict.fromkeys(parts))}
            columns, rows = {"text": objects(list(place)), **self.encode(list(place))}, np.array([place[c] for c in parts])
        if len(self.keys) > self.limit:
            self._thin()
        return columns, rows, first

    def _learn(self, keys: np.ndarray, where: list[np.ndarray], raw: bytes) -> None:
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), dtype=bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != keys[inside]
        if not new.any():
            return
        chunks = [raw[a:b] for a, b in zip(*(x[new].tolist() for x in where), strict=True)]
        fresh = {"text": objects(chunks), **self.encode(chunks)}
        size, end = len(self.uses), len(self.uses) + len(chunks)
        for name, x in fresh.items():  # room for as many again, so that columns are seldom copied
            if name not in self.columns or end > len(self.columns[name]):
                wider = np.empty(2 * end, dtype=x.dtype)
                wider[:size] = self.columns[name][:size] if size else x[:0]
                self.columns[name] = wider
            self.columns[name][size:end] = x
        self.slots = np.insert(self.slots, at[new], np.arange(size, end))
        self.keys = np.insert(self.keys, at[new], keys[new])
        self.uses = np.append(self.uses, np.zeros(len(chunks), dtype=np.int64))

    def _thin(self) -> None:
        """Forget all but the chunks that were met most often (half the limit at most)."""
        keep = np.argsort(-self.uses, kind="stable")[:self.limit // 2]
        keep = np.sort(keep[self.uses[keep] > 1])
        moved = np.full(len(self.uses), -1)
        moved[keep] = np.arange(len(keep))
        self.columns = {name: x[keep] for name, x in self.columns.items()}
        self.uses = self.uses[keep] // 2
        held = moved[self.slots] >= 0
        self.keys, self.slots = self.keys[held], moved[self.slots[held]]
