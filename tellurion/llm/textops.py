"""Texts of a batch as arrays: code points or bytes, words, hashes of any span.

A prefix sum of ``value(byte i) * BASE ** i`` modulo 2**64 gives the hash of any
span by a subtraction and a multiplication with the inverse power of its start,
so all words, windows and shingles of a batch are hashed without a loop.
"""

from __future__ import annotations

import numpy as np

from tellurion.llm.common import KEPT

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def forget_powers() -> None:
    """Drop the powers; they stay as long as the longest sequence so far otherwise."""
    _POWERS[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


KEPT["powers"] = forget_powers


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE ** i`` and its inverse for i below ``n``."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((BASE, BASE_INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalising steps of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


#: A 64-bit value for each byte.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * BASE)


class Spans:
    """Hashes of spans of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        power, self.inverse = powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * power[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
    return edges[0::2], edges[1::2]


def code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by a line feed, and the bounds of the texts.

    Text ``k`` lies between ``bounds[k]`` and ``bounds[k + 1] - 1``.
    """
    joined = "".join(f"{t or ''}\n" for t in texts)
    sizes = np.fromiter((len(t or "") + 1 for t in texts), np.int64, len(texts))
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.concatenate([[0], np.cumsum(sizes)])


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values between each two bounds; empty ranges give zero."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def words_in(
    inside: np.ndarray, bounds: np.ndarray, cuts: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside`` places within texts, and each text's first run.

    Texts lie between the bounds without anything between them; a run ends with its text, and
    before each place of ``cuts``.
    """
    breaks = np.zeros(len(inside) + 1, bool)
    breaks[bounds] = True
    if cuts is not None:
        breaks[cuts] = True
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & ~(before & ~breaks[:-1]))
    ends = np.flatnonzero(inside & ~(after & ~breaks[1:])) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def ragged_positions(sizes: np.ndarray, gap: int) -> np.ndarray:
    """Where the items of rows go when each row is followed by ``gap`` free places."""
    return np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)) * gap, sizes)
