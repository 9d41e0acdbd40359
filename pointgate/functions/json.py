"""JSON access: strict documents, dot paths, and many paths in one parse."""

from __future__ import annotations

import itertools
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointgate.functions.numbers import strict_double

# The text is parsed as the first element of a list that ends with a mark.  Text after the value (or several
# values) makes the parse fail or moves the mark, so both are noticed without a second parse.
_END = "~end-of-value~"
ROOT = "$[0]"
# A VARIANT holds no more than this; longer texts cannot be judged strictly.
_VARIANT_BYTES = 128 << 20


def parse_document(text: Column) -> Column:
    """Text -> VARIANT of [value, mark], to be staged as a column; the value is at ``ROOT``."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')))


def is_document(doc: str | Column) -> Column:
    """True when the text of the staged document was exactly one JSON value."""
    return F.coalesce(F.try_variant_get(doc, "$[1]", "string") == _END, F.lit(False))


def is_valid_json(text: Column) -> Column:
    """True when a text of any size is one JSON value.

    Texts beyond the limit of a VARIANT are judged by a streaming parse, which overlooks some damage inside the value.
    """
    wrapped = F.concat(F.lit('{"value":'), text, F.lit(f',"end":"{_END}"}}'))
    options = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    streamed = F.from_json(F.when(F.octet_length(text) > _VARIANT_BYTES, wrapped), "value string, end string", options)
    return is_document(parse_document(text)) | F.coalesce(streamed["end"] == _END, F.lit(False))


def _key(part: str) -> str:
    if not part:
        raise ValueError("empty JSON path part")
    if '"' not in part:
        return f'["{part}"]'
    if "'" not in part:
        return f"['{part}']"
    raise ValueError(f"JSON path part with both quote signs: {part!r}")


def _is_index(part: str) -> bool:
    return re.fullmatch(r"\+?\d+", part) is not None


def variant_paths(parts: list[str], index_only: bool = False, root: str = "$") -> list[str]:
    """Path parts -> VARIANT paths to try.

    A numeric part is an index on arrays and a key on objects (with ``index_only``: just an index).
    """
    choices = []
    for part in parts:
        if _is_index(part):
            index = f"[{int(part)}]"
            choices.append([index] if index_only else [index, _key(part)])
        else:
            choices.append([_key(part)])
    return [root + "".join(combo) for combo in itertools.product(*choices)]


def get_as(value: Column, parts: list[str], kind: str, index_only: bool = False, root: str = "$") -> Column:
    """The value at a path of a VARIANT.  As ``variant`` it is SQL null only when absent."""
    found = [F.try_variant_get(value, path, kind) for path in variant_paths(parts, index_only, root)]
    return found[0] if len(found) == 1 else F.coalesce(*found)


def value_type(value: Column) -> Column:
    """Type name of a VARIANT value; stage it as a column when it is needed more than once."""
    return F.schema_of_variant(value)


def is_number(type_name: Column) -> Column:
    return type_name.startswith("DECIMAL") | type_name.isin("BIGINT", "DOUBLE")


def is_string(type_name: Column) -> Column:
    return type_name == "STRING"


def string_or_null(value: Column) -> Column:
    """The text of a VARIANT that holds a JSON string, else null."""
    return F.when(is_string(value_type(value)), F.try_variant_get(value, "$", "string"))


def as_double(value: Column) -> Column:
    """A VARIANT holding a number, or a string that is a number; null for everything else."""
    return strict_double(F.try_variant_get(value, "$", "string"))


def unsigned(value: Column) -> Column:
    """A VARIANT holding a whole number >= 0 -> BIGINT; strings, fractions and negatives give null."""
    digits = F.when(value_type(value) == "BIGINT", F.try_variant_get(value, "$", "string"))
    return F.regexp_extract(digits, r"\A(\d+)\z", 1).try_cast("bigint")


@dataclass
class _Node:
    """A member of the document: the members below it, or the whole value."""

    children: dict[str, "_Node"] = field(default_factory=dict)
    leaf: str | None = None  # "string" or "variant"

    def add(self, parts: list[str], kind: str) -> None:
        if not parts:
            # The same path as text and as value, or a path that goes on below: keep the whole value.
            self.leaf = kind if self.leaf in (None, kind) and not self.children else "variant"
        elif self.leaf is not None or _is_index(parts[0]):
            self.leaf = "variant"
        else:
            self.children.setdefault(parts[0], _Node()).add(parts[1:], kind)
        if self.leaf is not None and self.children:
            self.leaf = "variant"
        names = [name.lower() for name in self.children]
        if len(set(names)) < len(names):
            # Names that differ by case only cannot be told apart as columns.
            self.leaf = "variant"
        if self.leaf is not None:
            self.children = {}

    def type(self) -> str:
        if self.leaf is not None:
            return self.leaf
        named = (f"`{name.replace('`', '``')}` {node.type()}" for name, node in self.children.items())
        return f"struct<{', '.join(named)}>"


def _read(members: str, node: _Node, parts: list[str], kind: str, index_only: bool) -> Column:
    column = F.col(members)
    while parts and node.leaf is None:
        column, node, parts = column.getField(parts[0]), node.children[parts[0]], parts[1:]
    if node.leaf == kind and not parts:
        return column
    return get_as(column, parts, kind, index_only)


def with_json_fields(
    df: DataFrame,
    text: Column,
    texts: Mapping[str, str] | None = None,
    values: Mapping[str, str] | None = None,
    ok: str = "__ok",
    index_only: bool = False,
) -> DataFrame:
    """Stage the members at dot paths as columns, in one parse of ``text``.

    ``texts`` (column -> path) gives members as text: numbers and booleans printed, nested values as JSON.
    ``values`` (column -> path) gives VARIANT, which keeps the kind of the member and tells null from absent.
    Column ``ok`` says whether the text was exactly one JSON value.  Only the named members are built; a
    numeric path part, whose meaning depends on the document, is looked up in a VARIANT.
    """
    wanted = [(name, path.split("."), "string") for name, path in (texts or {}).items()]
    wanted += [(name, path.split("."), "variant") for name, path in (values or {}).items()]
    for _, parts, _ in wanted:
        for part in parts:
            _key(part)
    root = _Node()
    for _, parts, kind in wanted:
        root.add(parts, kind)
    doc, members = "__json", "__members"
    staged = df.withColumn(doc, parse_document(text))
    if root.leaf is None and wanted:
        # One call reads all members; those of another kind than wanted are null.
        staged = staged.withColumn(members, F.try_variant_get(doc, ROOT, root.type()))
        columns = {name: _read(members, root, parts, kind, index_only) for name, parts, kind in wanted}
    else:
        columns = {name: get_as(F.col(doc), parts, kind, index_only, ROOT) for name, parts, kind in wanted}
    return staged.withColumns({ok: is_document(doc), **columns}).drop(doc, members)
