"""Every export's declared schema round-trips through JSON and feeds every one
of its tables (the JSON path, independent of the driver-table landing)."""

import os

import pytest
from pyspark.sql.types import ArrayType, StructType

from helpers import write_lines
from tradelake.plans.build import output_columns, table
from tradelake.plans.specs import PIPELINES
from tradelake.sources.jsonsrc import land_json
from tradelake.sources.registry import SOURCES, document_schema

# a value every rule accepts: active state, truthy code, integer-looking id
_VALUE = {"state": "A"}


def _fill(st: StructType, seed: int) -> dict:
    doc = {}
    for f in st.fields:
        if isinstance(f.dataType, ArrayType):
            doc[f.name] = [_fill(f.dataType.elementType, seed * 10 + i) for i in range(2)]
        else:
            doc[f.name] = _VALUE.get(f.name, str(seed))
    return doc


@pytest.mark.parametrize("source", SOURCES)
def test_source_roundtrip(spark, tmpdir_path, source):
    st = document_schema(source)
    docs = [dict(_ord=i, **_fill(st, i + 1)) for i in range(3)]
    exp = land_json(spark, source, write_lines(os.path.join(tmpdir_path, source), docs))
    for name in PIPELINES[source]:
        df = table(exp, name)
        assert df.columns == output_columns(name)
        assert df.count() > 0, name
