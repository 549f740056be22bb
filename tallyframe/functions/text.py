"""Text: JSON fields, file names and templates filled from the columns of a row."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FIELD = re.compile(r"\{(\w+)\}")


def json_field(col: Column, name: str) -> Column:
    """A field of a JSON text without quotes and outer blanks; '' when absent."""
    return F.coalesce(F.trim(F.get_json_object(col, f"$.{name}")), F.lit(""))


def json_fields(df: DataFrame, json: str, names: Sequence[str]) -> DataFrame:
    """Several fields as columns, like ``json_field``, from one parse of the text."""
    parsed = df.select("*", F.json_tuple(json, *names).alias(*[f"_{n}" for n in names]))
    texts = {n: F.coalesce(F.trim(F.col(f"_{n}")), F.lit("")) for n in names}
    return parsed.withColumns(texts).drop(*[f"_{n}" for n in names])


def explode_json_array(df: DataFrame, json_array: Column, name: str) -> DataFrame:
    """One row per text in a JSON array; a row without items stays, with ''."""
    item = F.explode_outer(F.from_json(json_array, "array<string>"))
    return df.withColumn(name, item).withColumn(name, F.coalesce(F.col(name), F.lit("")))


def safe_name(col: Column, to: str = "_") -> Column:
    """A value that can be part of a file name."""
    return F.replace(col.cast("string"), F.lit("/"), F.lit(to))


def template_fields(template: str) -> list[str]:
    return list(dict.fromkeys(_FIELD.findall(template)))


def render(template: str, fields: Mapping[str, Column], slash: str | None = None) -> Column:
    """Fill ``{name}`` places of a template from columns, in one expression per row.

    An unknown name raises. A NULL value shows as empty text. ``slash`` replaces "/"
    in the inserted values (not in the template itself), for file names.
    """
    missing = [name for name in template_fields(template) if name not in fields]
    if missing:
        raise KeyError(f"template refers to unknown fields {missing}")
    parts: list[Column] = []
    at = 0
    for match in _FIELD.finditer(template):
        if match.start() > at:
            parts.append(F.lit(template[at:match.start()]))
        value = fields[match.group(1)].cast("string")
        parts.append(F.coalesce(safe_name(value, slash) if slash else value, F.lit("")))
        at = match.end()
    if at < len(template):
        parts.append(F.lit(template[at:]))
    return F.concat(*parts) if parts else F.lit(template)
