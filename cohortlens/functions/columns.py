"""Column builders shared by the operators. All are JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def numeric(c) -> Column:
    """Lenient numeric coercion: unparsable text becomes null."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("double")
