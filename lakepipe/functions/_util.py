from __future__ import annotations

from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Union[Column, str]


def c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x
