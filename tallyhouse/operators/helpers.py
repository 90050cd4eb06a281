"""Names of helper columns that no column of the user's can have."""

from __future__ import annotations

from collections.abc import Iterable


def free_name(columns: Iterable[str], name: str) -> str:
    """`name`, lengthened until none of `columns` has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
