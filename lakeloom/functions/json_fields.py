"""Schema-free JSON objects: parse, read a key, merge keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions.text import as_column

# Valid JSON that counts as no event at all: empty object or array, zero, empty text, false, null.
EMPTY_JSON = r'^\s*(\{\s*\}|\[\s*\]|-?0(\.0+)?([eE][+-]?[0-9]+)?|""|false|null)\s*$'


def parse(col: str | Column) -> Column:
    """VARIANT, or NULL for text that is no JSON."""
    return F.try_parse_json(as_column(col))


def is_empty_json(col: str | Column) -> Column:
    return as_column(col).rlike(EMPTY_JSON)


def read_key(doc: str | Column, key: str, dtype: str = "string", default: str | None = None) -> Column:
    """A top-level or dotted key; NULL or ``default`` when absent, null, or of another type."""
    value = F.try_variant_get(as_column(doc), f"$.{key}", dtype)
    return value if default is None else F.coalesce(value, F.lit(default))


def merge_keys(doc: str | Column, values: dict[str, Column]) -> Column:
    """JSON text of an object with keys set; keys it already has are replaced, all others stay."""
    new = F.create_map(*[x for name, v in values.items() for x in (
        F.lit(name), F.coalesce(v.cast("variant"), F.parse_json(F.lit("null"))))])
    old = F.try_variant_get(as_column(doc), "$", "map<string,variant>")
    kept = F.map_filter(old, lambda k, _: ~k.isin(*values))
    return F.to_json(F.map_concat(kept, new))
