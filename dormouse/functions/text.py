"""Text shown to the people who read the results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mention(user_name: Column) -> Column:
    """Wiki mark-up that mentions a user; NULL for a NULL name."""
    return F.concat(F.lit("[~"), user_name, F.lit("]"))


def row_text(columns: list[str]) -> Column:
    """All given columns of a row as ``name=value`` pairs, NULLs included."""
    pairs = [
        F.concat(F.lit(f"{name}="), F.coalesce(F.col(name).cast("string"), F.lit("null")))
        for name in columns
    ]
    return F.concat_ws(", ", *pairs)
