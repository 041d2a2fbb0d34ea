"""Values as JSON text with a space after each comma and colon and with null members written out."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, MapType, NumericType, StructType


def quoted(c: Column) -> Column:
    """A text as a JSON string, NULL as ``null``."""
    listed = F.to_json(F.array(c.cast("string")))
    return F.when(c.isNull(), F.lit("null")).otherwise(listed.substr(F.lit(2), F.length(listed) - 2))


def json_text(c: Column, kind: DataType) -> Column:
    """Any value of the given type."""
    if isinstance(kind, StructType):
        members = [F.concat(F.lit(f'"{f.name}": '), json_text(c[f.name], f.dataType)) for f in kind.fields]
        text = F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}"))
    elif isinstance(kind, ArrayType):
        text = F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: json_text(x, kind.elementType)), ", "), F.lit("]"))
    elif isinstance(kind, MapType):
        entry = lambda e: F.concat(quoted(e["key"]), F.lit(": "), json_text(e["value"], kind.valueType))
        text = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(c), entry), ", "), F.lit("}"))
    elif isinstance(kind, (BooleanType, NumericType)):
        text = c.cast("string")
    else:
        return quoted(c)
    return F.when(c.isNull(), F.lit("null")).otherwise(text)
