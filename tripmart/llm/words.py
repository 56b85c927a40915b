"""Words and terms of whole texts as bytes, in pieces of bounded size."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

# lower-casing bytes changes A-Z only; bytes of characters beyond ASCII are all above 0x7F
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
SPACE = re.compile(rb"[\x20\x09-\x0d]")
GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
PIECE = 1 << 20  # bytes


def _pieces(data: bytes, border: re.Pattern) -> Iterator[bytes]:
    """The bytes in pieces of about ``PIECE``, cut where no word is."""
    at = 0
    while len(data) - at > PIECE:
        cut = border.search(data, at + PIECE)
        if cut is None:
            break
        yield data[at : cut.start()]
        at = cut.start()
    yield data[at:]


def words(data: bytes) -> Iterator[list[bytes]]:
    """Lower-cased words between ASCII blanks, by piece, in order."""
    for piece in _pieces(data.lower(), SPACE):
        yield piece.split()


def term_counts(data: bytes) -> Counter:
    """How often each run of ASCII letters, digits and characters beyond ASCII occurs, lower-cased."""
    counts: Counter = Counter()
    for piece in _pieces(data.lower(), GAP):
        counts.update(TERM.findall(piece))
    return counts
