"""Names of columns that an operator adds, kept apart from those of its input."""

from __future__ import annotations

from pyspark.sql import DataFrame


def set_aside(docs: DataFrame, prefix: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with every column renamed whose name begins with ``prefix`` in any case, and
    the new name of each renamed column. ``withColumnsRenamed`` with the reverse puts the old
    names back."""
    clashing = [name for name in docs.columns if name.lower().startswith(prefix)]
    taken, mark = {name.lower() for name in docs.columns}, "input_"
    while any((mark + name).lower() in taken for name in clashing):
        mark += "_"
    names = {name: mark + name for name in clashing}
    return (docs.withColumnsRenamed(names) if names else docs), names
