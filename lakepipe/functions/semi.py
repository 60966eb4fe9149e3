"""Semi-structured text: JSON whose fields drift, read as variants."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def typed_fields(df: DataFrame, json_col: str, fields: Mapping[str, tuple[str, str]], rejected: str = "rejected") -> DataFrame:
    """``df`` with one column for each ``{name: (path, type)}`` of a JSON text column, and the text itself where it does not fit.

    The text is parsed once, into a variant.  A field that is missing, JSON
    null or an array or object where a value is asked for, or whose value does
    not cast to the type, is NULL.  ``rejected`` holds the whole text where it
    is no JSON or where a value that is there did not cast (so nothing is
    lost), else NULL.  A NULL text gives NULLs.
    """
    parsed = df.withColumn("_doc", F.try_parse_json(F.col(f"`{json_col}`")))
    doc = F.col("_doc")
    values, misfits = {}, doc.isNull()
    for name, (path, kind) in fields.items():
        values[name] = F.try_variant_get(doc, path, kind)
        there = F.try_variant_get(doc, path, "variant")
        known = there.isNotNull() & ~F.is_variant_null(there)
        misfits = misfits | (known & F.try_variant_get(doc, path, kind).isNull())
    out = parsed.withColumns(values)
    return out.withColumn(rejected, F.when(F.col(f"`{json_col}`").isNotNull() & F.coalesce(misfits, F.lit(False)), F.col(f"`{json_col}`"))).drop("_doc")
