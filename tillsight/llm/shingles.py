"""Sets of word shingles as numbers, for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32
                for c in range(256))
_BASE = 0x9E3779B97F4A7C15
_WEIGHTS = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)
_powers = _inverses = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit number for each number (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            for name, base in (("_powers", _BASE), ("_inverses", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, base, dtype=np.uint64)
                steps[0] = 1
                globals()[name] = np.multiply.accumulate(steps)


#: Bytes hashed at once. Tables of powers as long as the longest stretch without a blank are kept to WIDEST.
AT_ONCE, WIDEST = 1 << 19, 1 << 21


def _sections(text: str | None) -> Iterator[bytes]:
    """The normalised text in parts of about AT_ONCE bytes, cut between words."""
    raw = (text or "").encode().translate(_NORMAL)
    start = 0
    while len(raw) - start > AT_ONCE and (cut := raw.find(b" ", start + AT_ONCE)) > 0:
        yield raw[start:cut]
        start = cut
    yield raw[start:]


def _hashes(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    codes = np.frombuffer(b" ".join([*parts, b""]), dtype=np.uint8)
    begins = np.cumsum([0] + [len(p) + 1 for p in parts])
    n = len(codes)
    _tables(n)
    blank = codes == 32
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    ends = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]])) + 1
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_WEIGHTS[codes] * _powers[:n], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * _inverses[starts])
    if n > WIDEST:
        _powers = _inverses = np.ones(1, dtype=np.uint64)
    return hashes, np.diff(np.searchsorted(starts, begins))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and how many words each text has.

    Words are runs of digits, letters and characters beyond ASCII, lower-cased (A-Z).
    """
    counts = np.zeros(len(texts), dtype=np.int64)
    found, parts, owners, size = [np.zeros(0, np.uint64)], [], [], 0

    def flush() -> None:
        nonlocal size
        if parts:
            hashes, numbers = _hashes(parts)
            found.append(hashes)
            np.add.at(counts, owners, numbers)
        parts.clear()
        owners.clear()
        size = 0

    for i, text in enumerate(texts):
        for part in _sections(text):
            parts.append(part)
            owners.append(i)
            size += len(part)
            if size >= AT_ONCE:
                flush()
    flush()
    return np.concatenate(found), counts


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text.

    A text of fewer words than a shingle has one shingle of all its words; a text
    without words has none.
    """
    hashes, counts = word_hashes(texts)
    n = len(hashes)
    with np.errstate(over="ignore"):
        rolled = np.zeros(n, dtype=np.uint64)
        for k in range(size):
            if n > k:
                rolled[:n - k] += hashes[k:] * np.uint64(2 * k * 0x632BE59BD9B4E019 + 1 & (1 << 64) - 1)
    rolled = mix(rolled)
    out, at = [], 0
    for count in counts.tolist():
        if count >= size:
            out.append(np.unique(rolled[at:at + count - size + 1]))
        elif count:
            with np.errstate(over="ignore"):
                short = np.uint64(count) + sum(
                    hashes[at + k:at + k + 1] * np.uint64(2 * k + 3) for k in range(count))
            out.append(mix(short))
        else:
            out.append(np.zeros(0, np.uint64))
        at += count
    return out
