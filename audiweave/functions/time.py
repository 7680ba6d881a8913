"""Column functions over timestamps."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(col: Column | str) -> Column:
    """Microseconds since 1970 of a timestamp with or without zone."""
    return F.unix_micros((F.col(col) if isinstance(col, str) else col).cast("timestamp"))
