"""Total orders expressed as a struct, so that "first row per key" becomes a
``min(struct)`` aggregate.  Spark compares structs field by field, and the
aggregate is partial (map-side), so a key holding a third of all rows is
collapsed in every map task before the shuffle instead of being sorted in
one reducer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


@dataclass(frozen=True)
class By:
    """One sort term: column name, direction, and where NULLs go."""
    column: str
    descending: bool = False
    nulls_last: bool | None = None  # default: ASC NULLS FIRST / DESC NULLS LAST

    def fields(self, schema) -> list[Column]:
        c = F.col(self.column)
        nulls_last = self.descending if self.nulls_last is None else self.nulls_last
        out = [c.isNull() if nulls_last else c.isNotNull()]
        if self.descending:
            if not isinstance(schema[self.column].dataType, NumericType):
                raise TypeError(f"descending order term {self.column!r} must be numeric")
            out.append(-c)
        else:
            out.append(c)
        return out


def order_struct(schema, terms: list[By], tail: list[str]) -> Column:
    """Struct whose natural ascending order is ``terms`` then ``tail``."""
    fields: list[Column] = []
    for i, t in enumerate(terms):
        for j, f in enumerate(t.fields(schema)):
            fields.append(f.alias(f"_o{i}_{j}"))
    fields += [F.col(c) for c in tail]
    return F.struct(*fields)
