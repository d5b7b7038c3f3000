"""Column-name cleaning (flat and nested).

Rule: tabs vanish, every blank becomes an underscore, letters become lower
case, and no underscore stays at either end.  Two columns of one level that
would get the same name are an error.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_LETTERS = str.maketrans({"\t": None, " ": "_"})


def clean_name(name: str) -> str:
    return name.translate(_LETTERS).lower().strip("_")


def _renaming(names: list[str], where: str) -> dict[str, str]:
    """Old to new names of one level; raises if two old ones meet."""
    by_new: dict[str, list[str]] = defaultdict(list)
    for n in names:
        by_new[clean_name(n)].append(n)
    for new, old in by_new.items():
        if len(old) > 1:
            raise ValueError(f"columns {old} of {where} would all be named {new!r}")
    return {old[0]: new for new, old in by_new.items()}


def clean_schema(schema: StructType) -> StructType:
    """The schema with cleaned names at every depth.  Works on the schema's
    JSON form, where each struct, however it is nested, is a list of fields."""
    tree = schema.jsonValue()
    pending = [("the table", tree)]
    while pending:
        where, node = pending.pop()
        if isinstance(node, dict) and isinstance(node.get("fields"), list):
            new = _renaming([f["name"] for f in node["fields"]], where)
            for f in node["fields"]:
                f["name"] = new[f["name"]]
                pending.append((f["name"], f["type"]))
        elif isinstance(node, dict):
            pending.extend((where, node[k]) for k in ("elementType", "keyType", "valueType") if k in node)
    return StructType.fromJson(tree)


def clean_column_names(df: DataFrame) -> DataFrame:
    """Top-level names only; a pure rename (no data touched)."""
    new = _renaming(df.columns, "the table")
    return df if all(k == v for k, v in new.items()) else df.toDF(*[new[c] for c in df.columns])


def clean_column_names_nested(df: DataFrame) -> DataFrame:
    """Names at every depth.  A column whose inner names change is cast to its
    cleaned type; struct casts go by position, so values stay as they are."""
    out = []
    for was, now in zip(df.schema, clean_schema(df.schema)):
        col = F.col("`" + was.name.replace("`", "``") + "`")
        out.append((col if was.dataType == now.dataType else col.cast(now.dataType)).alias(now.name))
    return df.select(*out)
