"""Lists of column names as job specifications write them."""

from __future__ import annotations

from collections.abc import Sequence


def column_names(given: str | Sequence[str] | None) -> list[str]:
    """Names from a comma list or a sequence."""
    names = given.split(",") if isinstance(given, str) else given or ()
    return [n.strip() for n in names if n.strip()]
