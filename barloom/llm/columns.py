"""Names for helper columns that a caller's table cannot already have."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """``wanted``, each with as many underscores in front as it takes to be no column of ``df`` in any letter case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found
