"""Bounded pieces of string columns for the vectorised word operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tierlake.llm.text import buffer_of


def segments(column: pa.Array, cuts: np.ndarray, max_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(bytes, offsets, document of each segment)`` of about ``max_bytes`` at a time.

    Documents stay whole, except those longer than ``max_bytes``: they are cut
    behind bytes that ``cuts`` (a table of 256 booleans) allows. A run without such a
    byte stays in one piece. A null is an empty text.
    """
    raw, offsets = buffer_of(column)
    begins, docs = offsets[:-1], np.arange(len(offsets) - 1)
    long = np.flatnonzero(np.diff(offsets) > max_bytes)
    if len(long):
        extra, owner = [], []
        for d in long.tolist():
            places = np.flatnonzero(cuts[raw[offsets[d]:offsets[d + 1]]]) + 1 + offsets[d]
            wanted = np.arange(offsets[d] + max_bytes, offsets[d + 1], max_bytes)
            at = np.unique(places[np.minimum(np.searchsorted(places, wanted), len(places) - 1)]) if len(places) else places
            at = at[(at > offsets[d]) & (at < offsets[d + 1])]
            extra.append(at)
            owner.append(np.full(len(at), d))
        begins = np.concatenate([begins, *extra])
        docs = np.concatenate([docs, *owner])
        order = np.lexsort((begins, docs))
        begins, docs = begins[order], docs[order]
    ends = np.append(begins[1:], offsets[-1])
    at = 0
    while at < len(begins):
        stop = max(at + 1, int(np.searchsorted(ends, begins[at] + max_bytes, side="right")))
        lo = begins[at]
        yield raw[lo:ends[stop - 1]], np.append(begins[at:stop], ends[stop - 1]) - lo, docs[at:stop]
        at = stop
