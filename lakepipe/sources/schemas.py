"""How a recorded schema grows when new files bring other columns."""

from __future__ import annotations

from pyspark.sql import types as T

# Types that Parquet files of the older type can be read as.
_WIDER = {
    "tinyint": ("smallint", "int", "bigint"),
    "smallint": ("int", "bigint"),
    "int": ("bigint",),
    "float": ("double",),
}


def widen_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """``old`` plus the columns only ``new`` has.  A column whose type
    changed takes the wider type when files of the other can be read as it;
    any other change is refused."""
    fields = {f.name: f for f in old.fields}
    for f in new.fields:
        have = fields.get(f.name)
        if have is None:
            fields[f.name] = T.StructField(f.name, f.dataType, True)
            continue
        a, b = have.dataType.simpleString(), f.dataType.simpleString()
        if b in _WIDER.get(a, ()):
            fields[f.name] = T.StructField(f.name, f.dataType, True)
        elif a != b and a not in _WIDER.get(b, ()):
            raise ValueError(f"column {f.name} changed its type from {a} to {b}")
    return T.StructType(list(fields.values()))
