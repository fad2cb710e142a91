"""Typed columns out of JSON documents, parsed once per row.

A table is described by a list of :class:`Field`. From that list come both the
schema of the parsed document (every leaf is text, as documents mix numbers and
numeric strings) and the typed projection. Parsing goes through a variant, which
keeps decimal numbers as they are written; ``from_json`` would round them to doubles. ``keep`` narrows the list *before*
parsing: Catalyst prunes columns of a scan but not fields of a parsed document
that several columns share, so the narrowing is done here.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.values import blank_to_null


@dataclass(frozen=True)
class Field:
    """One output column.

    ``paths`` are tried in order; ``blank`` says that "" counts as missing,
    otherwise "" reaches the cast and a typed cast of it raises. ``element``
    lists the text fields of an array of objects, which is kept as an array of
    structs for a later explode.
    """

    name: str
    paths: tuple[str, ...]
    type: str = "string"
    blank: bool = False
    element: str | None = None

    @property
    def ddl_type(self) -> str:
        return f"array<struct<{self.element}>>" if self.element else "string"

    def column(self, doc: str) -> Column:
        texts = [F.col(f"{doc}.{p}") for p in self.paths]
        if self.element:
            return texts[0].alias(self.name)
        if self.blank:
            texts = [blank_to_null(t) for t in texts]
        typed = [t if self.type == "string" else t.cast(self.type) for t in texts]
        value = typed[0] if len(typed) == 1 else F.coalesce(*typed)
        return value.alias(self.name)


def strict(name: str, path: str, type: str = "string") -> Field:
    return Field(name, (path,), type)


def lenient(name: str, path: str | tuple[str, ...], type: str) -> Field:
    return Field(name, (path,) if isinstance(path, str) else path, type, blank=True)


def objects(name: str, path: str, element: str) -> Field:
    return Field(name, (path,), element=element)


def texts(*names: str) -> list[Field]:
    """Text columns named like their document field."""
    return [strict(n, n) for n in names]


def struct_of(fields: Iterable[Field]) -> str:
    """Fields of the parsed document, as the inside of a struct type."""
    tree: dict[str, object] = {}
    for f in fields:
        for path in f.paths:
            head, _, leaf = path.partition(".")
            if leaf:
                tree.setdefault(head, {})[leaf] = "string"  # type: ignore[index]
            else:
                tree[head] = f.ddl_type
    return ", ".join(
        f"`{k}`: {v}" if isinstance(v, str)
        else f"`{k}`: struct<{', '.join(f'`{n}`: {t}' for n, t in v.items())}>"
        for k, v in tree.items()
    )


def narrowed(fields: Sequence[Field], keep: Iterable[str] | None) -> list[Field]:
    if keep is None:
        return list(fields)
    wanted = set(keep)
    unknown = wanted - {f.name for f in fields}
    if unknown:
        raise ValueError(f"no such staging columns: {sorted(unknown)}")
    return [f for f in fields if f.name in wanted]


def parse(
    df: DataFrame, fields: Sequence[Field], payload: str = "payload", doc: str = "doc"
) -> DataFrame:
    """Replace the payload text by its parsed form.

    A malformed document is an error, as it would be in a typed JSON column; of
    a repeated key the last value counts, as it would there.
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    others = [c for c in df.columns if c != payload]
    whole = F.variant_get(F.parse_json(F.col(payload)), "$", f"struct<{struct_of(fields)}>")
    return df.select(whole.alias(doc), *others)


def typed(fields: Sequence[Field], source: str) -> list[Column]:
    """Typed columns of a parsed document or of an exploded array element."""
    return [f.column(source) for f in fields]


def has_key(json_object: Column, key: str) -> Column:
    """Key present, even with a null value."""
    return F.array_contains(F.json_object_keys(json_object), F.lit(key))
