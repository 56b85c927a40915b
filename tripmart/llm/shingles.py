"""Words and word shingles of whole texts as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20_24)
_BYTES = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
# the same, with everything in ASCII that is neither letter nor digit as a blank
PLAIN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)
_IS_BLANK = np.isin(np.arange(256), list(BLANKS))
_BYTES[_IS_BLANK] = 0


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of each number over all its bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    powers = np.full(n, _BASE, dtype=np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def words(
    texts: list[bytes], change: bytes = LOWER
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and first byte of every word of every text, and the number of words per text.

    Words are runs of bytes that are not ASCII blanks after each byte was replaced by ``change``.
    The first byte is counted from the start of its text.
    """
    joined = b" ".join(texts) + b" "
    raw = np.frombuffer(joined.translate(change), dtype=np.uint8)
    blank = _IS_BLANK[raw]
    starts = np.nonzero(~blank & np.concatenate([[True], blank[:-1]]))[0]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    spans = np.diff(np.append(starts, len(raw)))
    place = np.arange(starts[0], len(raw), dtype=np.int64)
    place -= np.repeat(starts, spans)
    powers = _powers(int(spans.max()) + 1)
    value = _BYTES[raw[starts[0] :]]
    value *= powers[place]
    hashes = mix(np.add.reduceat(value, starts - starts[0]))
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    owner = np.searchsorted(begins, starts, side="right") - 1
    counts = np.bincount(owner, minlength=len(texts))
    return hashes, starts - begins[owner], counts


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The distinct shingles of ``width`` words of each text, sorted; of fewer words, them all as one."""
    hashes, _, counts = words(texts)
    if not len(hashes):
        return [np.zeros(0, np.uint64) for _ in texts]
    rolled = np.zeros(max(len(hashes) - width + 1, 0), np.uint64)
    for i in range(width):
        rolled += hashes[i : i + len(rolled)] * _ODD[i]
    rolled = mix(rolled)
    out, at = [], 0
    for n in counts.tolist():
        if n >= width:
            out.append(np.unique(rolled[at : at + n - width + 1]))
        elif n:
            whole = (hashes[at : at + n] * _ODD[width : width + n]).sum(dtype=np.uint64)
            out.append(mix(np.array([whole]) + _ODD[n - 1]))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out
