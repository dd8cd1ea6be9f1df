"""JSON text columns.

A model that reads many keys parses the text once per row: with_json adds a struct of strings as a column, and JsonDoc
reads fields of that column. Reading each key straight from the text would parse it once per key, because Catalyst
narrows every such parse to the key it serves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasklens.functions.typing import clean_string_array


def with_json(df: DataFrame, raw: str, scalars: Sequence[str] = (), arrays: Sequence[str] = (),
              name: str = "_doc") -> DataFrame:
    """The table with the named top-level keys of its JSON column parsed into one struct column."""
    return df.withColumn(name, _parse(raw, scalars, arrays))


class JsonDoc:
    """Access to the fields of a parsed column, knowing the text it came from."""

    def __init__(self, raw: str = "raw_json", fields: Column | None = None):
        self.raw = F.col(raw)
        self._fields = F.col("_doc") if fields is None else fields

    def scalar(self, key: str) -> Column:
        """Text of a scalar. Objects and arrays give NULL, as does broken JSON."""
        text = self._fields[key]
        return F.when(F.coalesce(~_bracketed(text), F.lit(True)), text).when(self._kind(key) == "STRING", text)

    def string_array(self, key: str) -> Column:
        """Array of scalars as text without blanks; a missing key or nested items give the empty array."""
        items = self._fields[key]
        suspect = F.coalesce(F.exists(items, _bracketed), F.lit(False))
        return clean_string_array(F.when(~suspect, items).when(self._kind(key) == "ARRAY<STRING>", items))

    def _kind(self, key: str) -> Column:
        # Tells the string "[x]" from an array. It stands in second branches only, where Spark evaluates it for the rows
        # that get there; beside an AND it would be taken out as a common expression and run for every row.
        return F.schema_of_variant(F.try_variant_get(F.try_parse_json(self.raw), f"$.{key}", "variant"))


def json_scalar(raw: str, key: str) -> Column:
    return JsonDoc(raw, _parse(raw, [key], [])).scalar(key)


def json_string_array(raw: str, key: str) -> Column:
    return JsonDoc(raw, _parse(raw, [], [key])).string_array(key)


def _parse(raw: str, scalars: Sequence[str], arrays: Sequence[str]) -> Column:
    fields = [f"`{k}` string" for k in scalars] + [f"`{k}` array<string>" for k in arrays]
    return F.from_json(F.col(raw), ", ".join(fields))


def _bracketed(text: Column) -> Column:
    return text.startswith("{") | text.startswith("[")
