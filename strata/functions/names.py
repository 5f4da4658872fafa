"""Internal column names that no input column has."""

from __future__ import annotations

from collections.abc import Iterable


def free_name(taken: Iterable[str], name: str) -> str:
    """``name``, lengthened until it is not among ``taken`` (any case)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def free_prefix(taken: Iterable[str], prefix: str) -> str:
    """``prefix``, lengthened until none of ``taken`` begins with it (any case)."""
    used = [c.lower() for c in taken]
    while any(c.startswith(prefix.lower()) for c in used):
        prefix += "_"
    return prefix
