"""Names of columns."""

from __future__ import annotations

from collections.abc import Iterable


def free_name(name: str, taken: Iterable[str]) -> str:
    """The name, with underscores before it until no column has it; case makes no difference."""
    held = {column.lower() for column in taken}
    while name.lower() in held:
        name = f"_{name}"
    return name
