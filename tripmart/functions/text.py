"""Functions on addresses, markup, lists and file sizes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# the generic URI split: group 3 is the path, group 4 the query
_URI = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"
# blanks at either end of a text: white space of Unicode and the separators U+001C to U+001F
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)
DEFAULT_SLUG = "feed"


def url_slug(url: Column) -> Column:
    """File-name part for an address: its query, else its path, as dash-joined words.

    A regular expression splits the address, so a malformed one never fails the job.
    """
    query = F.nullif(F.regexp_extract(url, _URI, 4), F.lit(""))
    path = F.regexp_replace(F.regexp_extract(url, _URI, 3), r";[^/]*$", "")
    words = F.regexp_replace(F.coalesce(query, path), r"[^a-zA-Z0-9]+", "-")
    slug = F.lower(F.btrim(words, F.lit("-")))
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit(DEFAULT_SLUG))


def tag_openings(markup: Column, tag: str) -> Column:
    """Openings of a tag, whatever its case: its name, then a space or ``>``."""
    return F.regexp_count(markup, F.lit(f"(?i)<{re.escape(tag)}[ >]"))


def comma_list(text: Column) -> Column:
    """The trimmed, non-empty values of a comma-separated list."""
    parts = F.transform(F.split(text, ","), lambda part: F.btrim(part, F.lit(BLANKS)))
    return F.filter(parts, lambda part: part != "")


def array_length(values: Column) -> Column:
    """Number of elements; 0 when the array is missing."""
    return F.coalesce(F.size(values), F.lit(0))


def kibibytes(n_bytes: Column) -> Column:
    return n_bytes / F.lit(1024.0)
