"""Names for helper columns beside the columns a table brings along."""

from __future__ import annotations

from collections.abc import Iterable


def free_name(name: str, taken: Iterable[str]) -> str:
    """The name, with underscores in front until no column has it (Spark ignores case)."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name
