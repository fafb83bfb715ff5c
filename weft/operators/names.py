"""Names for helper columns that no column of a frame can have."""

from __future__ import annotations

from collections.abc import Iterable


def fresh(columns: Iterable[str], *labels: str) -> list[str]:
    """A name for each label, longer than every name in ``columns``."""
    mark = "_" * (1 + max(map(len, columns), default=0))
    return [mark + label for label in labels]
