"""Census of landed fields: what the declared schema drops, and what never came.

The exports are read with declared schemas, so a field that the source adds or
renames is silently lost.  One pass over the landed lines reduces each document
to its shape (names and types, no values) and counts equal shapes, per task
first; only distinct shapes are shuffled.  Their paths are then held against the
declared ones:

* ``undeclared``: a path that documents hold and the schema drops (what lies
  below it is not listed);
* ``absent``: a declared path that no document holds, though some hold what it
  would stand in;
* ``mixed``: a declared list or object that also holds other things;
* ``broken``: lines that are no JSON object.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from .registry import line_schema

_NAME = re.compile(r"`((?:[^`]|``)*)`|([^\s:<>,`]+)")
_SCALAR = re.compile(r"[A-Z_]+(?:\([0-9, ]+\))?")


def _declared(schema: StructType, above: str = "") -> dict[str, bool]:
    """path -> whether it is a list of objects."""
    out = {}
    for f in schema.fields:
        path = f"{above}{f.name}"
        out[path] = isinstance(f.dataType, ArrayType)
        if out[path]:
            out |= _declared(f.dataType.elementType, f"{path}.")
    return out


class Shape:
    """A document's shape, ``OBJECT<name: type, ...>``, read from its text."""

    def __init__(self, text: str) -> None:
        self.text, self.at = text, 0

    def _take(self, token: str) -> bool:
        if self.text.startswith(token, self.at):
            self.at += len(token)
            return True
        return False

    def read(self) -> dict | list | str:
        """A dict for an object, a list of one for an array, else a type name."""
        if self._take("OBJECT<"):
            fields: dict = {}
            while not self._take(">"):
                self._take(", ")
                m = _NAME.match(self.text, self.at)
                name = m[1].replace("``", "`") if m[1] is not None else m[2]
                self.at = m.end() + 2                # ": "
                fields[name] = self.read()
            return fields
        if self._take("ARRAY<"):
            inner = self.read()
            self.at += 1
            return [inner]
        m = _SCALAR.match(self.text, self.at)
        self.at = m.end()
        return m[0].partition("(")[0]


def _type(shape: dict | list | str) -> str:
    return "OBJECT" if isinstance(shape, dict) else f"ARRAY<{_type(shape[0])}>" if isinstance(shape, list) else shape


def findings(shape: dict | list | str, declared: dict[str, bool], above: str = "") -> Iterator[tuple[str, str, str]]:
    """(path, finding, type) of a document: ``undeclared``, ``mixed`` or ``present``."""
    for name, value in shape.items():
        path = f"{above}{name}"
        if path not in declared:
            yield path, "undeclared", _type(value)
            continue
        yield path, "present", _type(value)
        if not declared[path] or value == "VOID":       # null
            continue
        inner = value[0] if isinstance(value, list) else None
        if isinstance(inner, dict):
            yield from findings(inner, declared, f"{path}.")
        elif inner != "VOID":                           # no list, or not one of objects
            yield path, "mixed", _type(value)


def census(spark: SparkSession, source: str, path: str) -> DataFrame:
    """(path, finding, documents, types) of the JSON Lines at ``path``."""
    declared = _declared(line_schema(source))
    lines = spark.read.text(path).where(F.trim("value") != "")
    shapes = lines.groupBy(F.schema_of_variant(F.try_parse_json("value")).alias("shape")).agg(F.count(F.lit(1)).alias("documents"))

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shape = Shape(text).read() if text else None
                if isinstance(shape, dict):
                    rows += [("", "present", "OBJECT", n), *((*f, n) for f in findings(shape, declared))]
                else:
                    rows.append(("", "broken", _type(shape) if shape else "", n))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema) if rows else \
                pa.RecordBatch.from_pylist([], schema=schema)

    schema = pa.schema([("path", pa.string()), ("finding", pa.string()), ("type", pa.string()), ("n", pa.int64())])
    seen = shapes.mapInArrow(paths, "path string, finding string, type string, n long").groupBy("path", "finding").agg(
        F.sum("n").alias("documents"), F.array_join(F.sort_array(F.collect_set("type")), ", ").alias("types"))
    # a declared path is missed where its parent (or, for a field of the document, any document) was seen
    wanted = spark.createDataFrame([(p, p.rpartition(".")[0]) for p in declared if p != "_ord"], "path string, above string")
    present = seen.where("finding = 'present'").select("path")
    absent = wanted.join(present, "path", "left_anti").join(present.withColumnRenamed("path", "above"), "above", "left_semi")
    return seen.where("finding <> 'present'").unionByName(
        absent.select("path", F.lit("absent").alias("finding"), F.lit(0).cast("long").alias("documents"), F.lit("").alias("types")))
