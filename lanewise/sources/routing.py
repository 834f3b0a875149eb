"""Which raw table a delivered file belongs to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lanewise.schemas import TABLES

UNROUTED = "unrouted"


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def route(file_name: Column) -> Column:
    """Table named by the first token found in a ``.csv`` file name, else ``unrouted``.

    Case-sensitive, tokens tried in declaration order, so ``ports_regions.csv`` is a
    regions file and is loaded once.
    """
    is_csv = file_name.endswith(".csv")
    choice = F.when(~is_csv, UNROUTED)
    for table in TABLES:
        choice = choice.when(file_name.contains(table), table)
    return choice.otherwise(UNROUTED)
