"""Hashes of the words of a text, for whole texts at once in numpy."""

from __future__ import annotations

#: Bytes that are hashed at once.
SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_tables: dict = {}


def mixed(h):
    """The 64-bit values `h`, mixed."""
    import numpy as np

    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _powers():
    import numpy as np

    if "up" not in _tables:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            row = np.full(SEGMENT + 1, base, "uint64")
            row[0] = 1
            _tables[name] = np.multiply.accumulate(row)
    return _tables["up"], _tables["down"]


def _segments(text: bytes):
    """(start, end) of pieces that end at ASCII white space; longer than `SEGMENT` only where a single word is."""
    import re

    space, at = re.compile(rb"[\x20\x09-\x0D]"), 0
    while at < len(text):
        end = at + SEGMENT
        if end < len(text):
            tail = text[at:end]
            cut = max(tail.rfind(c) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut >= 0:
                end = at + cut + 1
            else:
                m = space.search(text, end)
                end = m.end() if m else len(text)
        end = min(end, len(text))
        yield at, end
        at = end


def word_hashes(text: bytes):
    """(hash of each word, its first byte's place), words being runs without ASCII white space.

    A word is a polynomial in an odd base modulo 2^64, read off the running sum of the bytes times powers of the base.
    """
    import numpy as np
    import xxhash

    up, down = _powers()
    hashes, starts = [np.zeros(0, "uint64")], [np.zeros(0, "int64")]
    for a, b in _segments(text):
        if b - a > SEGMENT:
            word = text[a:b].strip()
            if word:
                hashes.append(np.array([xxhash.xxh64_intdigest(word)], "uint64"))
                starts.append(np.array([a + text[a:b].index(word)]))
            continue
        raw = np.frombuffer(text, "u1", b - a, a)
        space = np.ones(b - a + 2, bool)
        space[1:-1] = (raw == 32) | ((raw >= 9) & (raw <= 13))
        edge = np.flatnonzero(space[1:] != space[:-1])
        start, end = edge[::2], edge[1::2]
        total = np.zeros(b - a + 1, "uint64")
        np.cumsum((raw.astype("uint64") + np.uint64(1)) * up[: b - a], out=total[1:])
        hashes.append(mixed((total[end] - total[start]) * down[start]))
        starts.append(start + a)
    return np.concatenate(hashes), np.concatenate(starts)


def _kinds():
    """0 for white space, 1 for letters and all bytes beyond ASCII, 2 for digits, 3 for others."""
    import numpy as np

    if "kinds" not in _tables:
        out = np.full(256, 3, "u1")
        out[[9, 10, 11, 12, 13, 32]] = 0
        out[65:91] = out[97:123] = out[128:] = 1
        out[48:58] = 2
        _tables["kinds"] = out
    return _tables["kinds"]


def token_hashes(text: bytes):
    """Arrays of the hashes of a text's tokens in order: runs of letters, of digits, and of other characters without white space.

    A text is cut at white space into pieces of at most `SEGMENT` bytes, and a longer run without white space at that length.
    """
    import numpy as np

    up, down = _powers()
    kinds = _kinds()
    for a, b in _segments(text):
        for at in range(a, b, SEGMENT):
            size = min(SEGMENT, b - at)
            raw = np.frombuffer(text, "u1", size, at)
            kind = np.zeros(size + 2, "u1")
            kind[1:-1] = kinds[raw]
            edge = np.flatnonzero(kind[1:] != kind[:-1])
            start = edge[kind[edge + 1] > 0]
            end = edge[kind[edge] > 0]
            total = np.zeros(size + 1, "uint64")
            np.cumsum((raw.astype("uint64") + np.uint64(1)) * up[:size], out=total[1:])
            yield mixed((total[end] - total[start]) * down[start])
