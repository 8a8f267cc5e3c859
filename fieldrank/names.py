"""Column names that come from data may hold any character."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column of exactly this name; dots and backticks in it mean nothing else."""
    return F.col("`" + name.replace("`", "``") + "`")
