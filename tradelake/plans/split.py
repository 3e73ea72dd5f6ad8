"""All tables of an export in one pass over its documents.

For exports none of whose tables filters or de-duplicates (visits: 15 tables),
a document's rows of all tables are one array of tagged rows, exploded at once:
one scan, no shuffle, one job.  A tagged row has the columns of all tables; those
of other tables are NULL.  A column that several tables have is coerced once,
behind the explode, so it has to be coerced alike in all of them
(:func:`in_one_pass` tells).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from ..operators import clean as C
from ..sources.export import path_depth
from .specs import PIPELINES, SPEC_BY_NAME, SPECS, TableSpec

TAG = "table"
_CAST = {"long": C.to_int, "double": C.to_float, "boolean": C.to_bool}


def _kinds(name: str) -> dict[str, str]:
    """Column -> what it is coerced to, inherited columns included."""
    spec = SPEC_BY_NAME[name]
    above = _kinds(spec.parent) if spec.parent else {}
    own = {c: kind for kind in _CAST for c in spec.typed(kind)}
    return {c: above[c] if c in spec.inherited else own.get(c, "text") for c in spec.columns}


def _narrow(spec: TableSpec) -> bool:
    """No filter, no de-duplication, no text rule but a default."""
    return not (spec.active or spec.active_or_blank or spec.truthy or spec.strip or spec.blank_null or spec.strip_truthy
                or spec.upper or spec.dropna or spec.key is not None or spec.distinct or spec.label)


def in_one_pass(source: str) -> bool:
    """Can all tables of the export come out of one pass?"""
    if len(PIPELINES[source]) < 2 or not all(_narrow(s) for s in SPECS if s.source == source):
        return False
    kinds: dict[str, str] = {}
    return all(kinds.setdefault(c, k) == k for name in PIPELINES[source] for c, k in _kinds(name).items())


def columns_of(source: str) -> dict[str, str]:
    """The columns of all tables of the export, with what they are coerced to."""
    return {c: k for name in PIPELINES[source] for c, k in _kinds(name).items()}


def _value(spec: TableSpec, field: str, at: list[Column]) -> Column:
    """The raw text of ``field``, ``at`` the elements that lead to a row."""
    if field in spec.inherited:
        return _value(SPEC_BY_NAME[spec.parent], field, at)
    if spec.first_of and field == spec.first_of[1]:                                   # O15
        value = F.get(F.filter(F.col(spec.first_of[0]), lambda e: e.isNotNull()), F.lit(0))[field]
    else:
        depth = path_depth(spec.path)
        value = at[depth - 1][field] if depth else F.col(field)
    return F.coalesce(value, F.lit("")) if field in spec.default_blank else value


def _rows(name: str, columns: list[str]) -> Column:
    """The document's rows of a table, as an array of tagged rows."""
    spec = SPEC_BY_NAME[name]
    steps = spec.path.split(".") if spec.path else []

    def row(at: list[Column]) -> Column:
        fields = [(_value(spec, c, at) if c in spec.columns else F.lit(None).cast("string")).alias(c) for c in columns]
        return F.struct(F.lit(name).alias(TAG), *fields)

    def below(at: list[Column]) -> Column:
        step = steps[len(at)]
        there = F.filter(at[-1][step] if at else F.col(step), lambda e: e.isNotNull())
        if len(at) + 1 == len(steps):
            return F.coalesce(F.transform(there, lambda e: row([*at, e])), F.array())
        return F.coalesce(F.flatten(F.transform(there, lambda e: below([*at, e]))), F.array())

    return below([]) if steps else F.array(row([]))


def split(docs: DataFrame, source: str) -> DataFrame:
    """The rows of all tables, tagged; text as it was read."""
    columns = list(columns_of(source))
    rows = F.concat(*[_rows(name, columns) for name in PIPELINES[source]])
    return docs.select(F.explode(rows).alias("_r")).select("_r.*")


def typed(rows: DataFrame, source: str) -> DataFrame:
    """The tagged rows with their columns coerced."""
    kinds = columns_of(source)
    return rows.select(TAG, *[(_CAST[k](c) if k in _CAST else F.col(c)).alias(c) for c, k in kinds.items()])


def reject_counts(source: str) -> list[Column]:
    """Aggregates ``<table>.<column>`` over the tagged text rows: what the
    table's integer casts refuse (D2)."""
    out = []
    for name in PIPELINES[source]:
        spec = SPEC_BY_NAME[name]
        for c in (c for c in spec.typed("long") if c not in spec.inherited):
            out.append(F.count_if((F.col(TAG) == name) & C.int_reject(c)).alias(f"{name}.{c}"))
    return out


def schema_of(name: str, schema: StructType) -> StructType:
    """A table's own columns of the tagged rows' schema."""
    kinds: dict[str, DataType] = {f.name: f.dataType for f in schema.fields}
    return StructType([StructField(c, kinds[c]) for c in SPEC_BY_NAME[name].columns])


def table_from_split(rows: DataFrame, name: str) -> DataFrame:
    """One table of the typed tagged rows."""
    return rows.where(F.col(TAG) == name).select(*SPEC_BY_NAME[name].columns)


def row_counts(source: str) -> list[Column]:
    """Aggregates ``<table>``: the rows of each table."""
    return [F.count_if(F.col(TAG) == name).alias(name) for name in PIPELINES[source]]
