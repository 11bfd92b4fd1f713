"""Golomb-Rice coding of sorted 64-bit numbers, with numpy."""

from __future__ import annotations

import numpy as np


def rice_parameter(count: int, span: int) -> int:
    """Bits of the remainder that suit ``count`` numbers spread over ``span``."""
    return max(0, (span // max(1, count)).bit_length() - 1)


def encode(values: np.ndarray, bits: int) -> bytes:
    """Sorted unsigned numbers as gaps: the quotient in unary, then ``bits`` bits of remainder."""
    if not len(values):
        return b""
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    quotients = (gaps >> np.uint64(bits)).astype(np.int64)
    ends = np.cumsum(quotients + 1 + bits)
    stream = np.zeros(ends[-1], dtype=np.uint8)
    stops = ends - 1 - bits
    unary = np.repeat(ends - (quotients + 1 + bits), quotients) + (
        np.arange(quotients.sum()) - np.repeat(np.cumsum(quotients) - quotients, quotients)
    )
    stream[unary] = 1
    for bit in range(bits):
        stream[stops + 1 + bit] = (gaps >> np.uint64(bits - 1 - bit)).astype(np.uint8) & 1
    return np.packbits(stream).tobytes()


def decode(message: bytes, count: int, bits: int) -> np.ndarray:
    """The numbers that ``encode`` was given."""
    if not count:
        return np.zeros(0, dtype=np.uint64)
    stream = np.unpackbits(np.frombuffer(message, dtype=np.uint8))
    zeros = np.flatnonzero(stream == 0)
    # The stop bit of a number is the first zero from the end of the number before it.
    stops = np.empty(count, dtype=np.int64)
    at = 0
    following = np.searchsorted(zeros, np.arange(0, len(stream) + 1))
    for i in range(count):
        stops[i] = zeros[following[at]]
        at = stops[i] + 1 + bits
    starts = np.concatenate(([0], stops[:-1] + 1 + bits))
    gaps = (stops - starts).astype(np.uint64) << np.uint64(bits)
    for bit in range(bits):
        gaps |= stream[stops + 1 + bit].astype(np.uint64) << np.uint64(bits - 1 - bit)
    return np.cumsum(gaps, dtype=np.uint64)
