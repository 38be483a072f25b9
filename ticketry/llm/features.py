"""Hashed byte n-gram counts of whole texts, whole batches at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from ticketry.llm.common import batches_of

#: Bytes that are counted at once; longer texts are counted in pieces that overlap by an n-gram less one byte.
PIECE = 1 << 19
_ODD = np.uint32(0x9E3779B1)


def gram_indices(raw: np.ndarray, width: int, size: int) -> np.ndarray:
    """The slot below ``size`` of the n-gram that starts at each byte but the last ``width`` - 1."""
    n = max(0, len(raw) - width + 1)
    h = np.full(n, width, np.uint32)
    with np.errstate(over="ignore"):
        for i in range(width):
            h = (h ^ raw[i:i + n]) * _ODD
            h ^= h >> np.uint32(15)
    return (h % np.uint32(size)).astype(np.int64)


def gram_counts(texts: list[bytes], width: int, size: int) -> Iterator[np.ndarray]:
    """One row of ``size`` counts for each text, in lists that fit into memory."""
    for batch in batches_of(texts, lambda t: len(t) + size // 4, PIECE):
        counts = np.zeros((len(batch), size), np.int64)
        if len(batch) == 1:
            for start in range(0, max(1, len(batch[0]) - width + 1), PIECE):
                part = np.frombuffer(batch[0], np.uint8)[start:start + PIECE + width - 1]
                counts[0] += np.bincount(gram_indices(part, width, size), minlength=size)
        else:
            raw = np.frombuffer(b"".join(batch), np.uint8)
            lengths = np.array([len(t) for t in batch])
            slots = gram_indices(raw, width, size)
            owner = np.repeat(np.arange(len(batch)), lengths)[:len(slots)]
            # n-grams over the end of a text belong to none
            inside = np.arange(len(slots)) + width <= np.cumsum(lengths)[owner]
            counts += np.bincount((owner * size + slots)[inside], minlength=len(batch) * size).reshape(len(batch), size)
        yield counts
