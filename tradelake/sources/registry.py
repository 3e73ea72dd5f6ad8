"""Source registry (S4): the 22 exports, their envelope keys and declared schemas.

The declared schema of each export is derived from the table specs: every leaf
a builder reads is a string (the exports carry text), every nesting path is an
``array<struct>``.  Reading with a declared schema (never inference) keeps the
scan splittable and prunes undeclared fields at the reader.
"""

from __future__ import annotations

from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ..plans.specs import SPECS

# Export name -> key of the record list inside the response
# envelope (S3).  Two exports share "inventory" and two share "movement".
ENVELOPE_KEYS = {
    "products": "inventory",
    "natural_person": "natural_person",
    "services": "service",
    "product_group": "product_group",
    "price_type": "data",
    "inventory_price": "inventory",
    "producers": "producer",
    "legal_entity": "legal_person",
    "person_group": "person_group",
    "workspaces": "room",
    "contracts": "contract",
    "return_reason": "return_reason",
    "order": "order",
    "returns": "return",
    "visit": "visit",
    "cross_movement": "movement",
    "internal_movement": "movement",
    "stocktaking": "stocktaking",
    "writeoff": "writeoff",
    "warehouse_input": "input",
    "purchase": "purchase",
    "logistics": "logistics",
}

SOURCES = list(ENVELOPE_KEYS)


def _fields_by_path(source: str) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for s in SPECS:
        if s.source != source:
            continue
        parts = s.path.split(".") if s.path else []
        for i in range(len(parts) + 1):            # intermediate paths exist too
            out.setdefault(".".join(parts[:i]), [])
        fields = out[s.path]
        own = [f for f in s.read_fields if f not in s.inherited]
        if s.first_of:
            own = [f for f in own if f != s.first_of[1]]
            cpath, cfield = s.first_of
            out.setdefault(cpath, [])
            if cfield not in out[cpath]:
                out[cpath].append(cfield)
        for f in own:
            if f not in fields:
                fields.append(f)
    return out


def document_schema(source: str) -> StructType:
    """Declared schema of one document of ``source`` (all leaves text)."""
    by_path = _fields_by_path(source)

    def struct_at(path: str) -> StructType:
        prefix = path + "." if path else ""
        children = sorted({p[len(prefix):].split(".")[0] for p in by_path
                           if p.startswith(prefix) and p != path and p})
        fs = [StructField(f, StringType()) for f in by_path.get(path, [])]
        fs += [StructField(c, ArrayType(struct_at(prefix + c))) for c in children]
        return StructType(fs)

    return struct_at("")


def line_schema(source: str) -> StructType:
    """JSON Lines layout: one document per line plus its landing order ``_ord``."""
    return StructType([StructField("_ord", LongType())] + document_schema(source).fields)
