"""Token ids of whole texts, with the ids of repeated pieces kept for reuse.

A byte-level BPE tokenizer never joins a character before a single space to
what follows it, as long as neither neighbour of that space is white space. So
a text can be cut before such spaces, each piece encoded once by the tokenizers
library and its ids reused wherever the piece comes again. Added tokens such as
``<|endoftext|>`` are found by the library within their piece. The ids are those of
the whole text, with the tokenizer as it is loaded; ``tests/llm/test_tokens.py`` holds them against it.

Pieces are told apart by a 64-bit hash, their length and their last bytes, and
looked up for a whole batch at once in sorted arrays of about 40 bytes a piece.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from tellurion.llm.common import KEPT, chunks, ragged, utf8
from tellurion.llm.textops import BYTE_VALUES, Spans

#: Pieces kept until the table is emptied; new ones are merged in from a small table.
MAX_PIECES, RECENT = 1_400_000, 100_000
#: Bytes of text that are encoded at a time.
BATCH_BYTES = 1 << 20
#: New pieces that the library encodes at a time; it takes several times their size.
LEARN = 50_000
#: The same for encoders that are short of memory; smaller tables take more time.
LEAN = {"max_pieces": 500_000, "recent": 50_000, "learn": 8192}
SPACE = 32
_ASCII_SPACES = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])

_ENCODERS: dict[tuple[str, bool], PieceEncoder] = {}
KEPT["tokens"] = _ENCODERS.clear


def encoder(path: str, lean: bool = False) -> PieceEncoder:
    """The encoder of this Python worker for a tokenizer file."""
    if (path, lean) not in _ENCODERS:
        _ENCODERS[path, lean] = PieceEncoder(path, **(LEAN if lean else {}))
    return _ENCODERS[path, lean]


def white_space(data: np.ndarray) -> np.ndarray:
    """Bytes of white space characters in UTF-8; more than there are does no harm."""
    found = _ASCII_SPACES[data]
    if (data >= 0xC2).any():
        first, second = data[:-1], data[1:]
        two = (first == 0xC2) & ((second == 0x85) | (second == 0xA0))
        # White space of three bytes starts with E1 9A, E2 80, E2 81 or E3 80.
        three = (first == 0xE1) & (second == 0x9A) | (first == 0xE2) & ((second == 0x80) | (second == 0x81))
        three |= (first == 0xE3) & (second == 0x80)
        found[:-1] |= two | three
        found[1:] |= two | three
        found[2:] |= three[:-1]
    return found


class Table:
    """Ids by piece: sorted hashes, lengths with last bytes, and where the ids lie."""

    def __init__(self):
        self.first = self.second = np.zeros(0, np.uint64)
        self.start = self.length = np.zeros(0, np.int32)

    def find(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each piece is there, and at which place."""
        if not len(self.first):
            return np.zeros(len(first), bool), np.zeros(len(first), np.int64)
        at = np.minimum(np.searchsorted(self.first, first), len(self.first) - 1)
        return (self.first[at] == first) & (self.second[at] == second), at

    def merge(self, other: Table) -> None:
        first = np.concatenate([self.first, other.first])
        order = np.argsort(first, kind="stable")
        self.first = first[order]
        for name in ("second", "start", "length"):
            both = np.concatenate([getattr(self, name), getattr(other, name)])
            setattr(self, name, both[order])


class PieceEncoder:
    """Encodes lists of texts; keeps a bounded table of pieces and their ids."""

    def __init__(
        self, path: str, max_pieces: int = MAX_PIECES, recent: int = RECENT, learn: int = LEARN
    ):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Added tokens with spaces, or that take spaces in, do not allow for cuts at spaces.
        self.whole = any(
            " " in t.content or t.lstrip or t.rstrip or t.single_word
            for t in self.tokenizer.get_added_tokens_decoder().values()
        )
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.id_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.id_bytes[i] = len(token)  # one character of a token stands for a byte
        self.max_pieces, self.most_recent, self.learn = max_pieces, recent, learn
        self._clear()

    def _clear(self) -> None:
        self.kept, self.recent = Table(), Table()
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def _add(self, ids: np.ndarray) -> int:
        """Put ids at the end of the buffer; returns where they start."""
        start = self.used
        if start + len(ids) > len(self.ids):
            wider = np.zeros(max(2 * len(self.ids), start + len(ids)), np.uint32)
            wider[:start] = self.ids[:start]
            self.ids = wider
        self.ids[start : start + len(ids)] = ids
        self.used += len(ids)
        return start

    def _learn(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Encode pieces; where the ids of each start, and their number."""
        texts = [p.decode() for p in pieces]
        # Pieces that can follow each other are encoded as one text and told apart by their bytes.
        even = [
            k for k, t in enumerate(texts)
            if t[0] == " " and len(t) > 1 and not t[1].isspace() and not t[-1].isspace()
        ]
        start, length = np.zeros(len(pieces), np.int32), np.zeros(len(pieces), np.int32)
        for at in range(0, len(even), self.learn):
            part = np.array(even[at : at + self.learn])
            whole = "".join(texts[k] for k in part)
            ids = np.array(self.tokenizer.encode(whole, add_special_tokens=False).ids, np.uint32)
            ends = np.cumsum([len(pieces[k]) for k in part])
            cuts = np.searchsorted(np.cumsum(self.id_bytes[ids]), ends) + 1
            length[part] = np.diff(cuts, prepend=0)
            start[part] = self._add(ids) + cuts - length[part]
        odd = sorted(set(range(len(texts))).difference(even))
        found = self.tokenizer.encode_batch_fast([texts[k] for k in odd], add_special_tokens=False)
        for k, one in zip(odd, found):
            start[k], length[k] = self._add(np.array(one.ids, np.uint32)), len(one.ids)
        return start, length

    def encode(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and the number of each text's ids."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        data, offsets = utf8(texts)
        parts = [
            self._encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            for a, b in chunks(np.diff(offsets), BATCH_BYTES)
        ]
        ids = np.concatenate([np.zeros(0, np.uint32), *(i for i, _ in parts)])
        return ids, np.concatenate([np.zeros(0, np.int64), *(c for _, c in parts)])

    def _encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(bounds) - 1, np.int64)
        white = white_space(data)
        cut = np.zeros(len(data) + 1, bool)
        if not self.whole:
            cut[1:-2] = (data[1:-1] == SPACE) & ~white[:-2] & ~white[2:]
        # A space next to the end of a text, or to another text, is no place to cut.
        cut[np.clip(bounds - 1, 0, len(data))] = False
        cut[bounds] = True
        starts = np.flatnonzero(cut[:-1])
        ends = np.append(starts[1:], len(data))
        first = Spans(BYTE_VALUES[data]).of(starts, ends)
        second = (ends - starts).astype(np.uint64) << np.uint64(48)
        for k in range(6):
            last = data[np.maximum(ends - 1 - k, starts)].astype(np.uint64)
            second |= last << np.uint64(8 * k)
        distinct, example, which = np.unique(first, return_index=True, return_inverse=True)
        if (second != second[example][which]).any():  # two pieces with one first hash
            distinct, example, which = first, np.arange(len(first)), np.arange(len(first))
        start, length = self._rows(distinct, second[example], data, starts[example], ends[example])
        start, length = start[which], length[which].astype(np.int64)
        ids = self.ids[ragged(start.astype(np.int64), length)]
        total = np.concatenate([[0], np.cumsum(length)])
        return ids, np.diff(total[np.searchsorted(starts, bounds)])

    def _rows(self, first, second, data, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each piece start, and their number; new pieces are encoded."""
        if len(self.kept.first) > self.max_pieces or self.used > 16 * self.max_pieces:
            self._clear()
        start, length = np.zeros(len(first), np.int32), np.zeros(len(first), np.int32)
        known = np.zeros(len(first), bool)
        for table in (self.kept, self.recent):
            there, at = table.find(first, second)
            start[there], length[there] = table.start[at[there]], table.length[at[there]]
            known |= there
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            pieces = [raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())]
            start[new], length[new] = self._learn(pieces)
            found = Table()
            order = new[np.argsort(first[new], kind="stable")]
            found.first, found.second = first[order], second[order]
            found.start, found.length = start[order], length[order]
            self.recent.merge(found)
            if len(self.recent.first) > self.most_recent:
                self.kept.merge(self.recent)
                self.recent = Table()
        return start, length
