"""Keep-first (O9) against a brute-force reference: pandas
``drop_duplicates(keep="first")`` on rows in record order, NULL keys equal."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tradelake.operators.dedup import keep_first

ROW = st.tuples(st.sampled_from([None, "a", "b", "c"]), st.sampled_from([None, 1, 2]),
                st.integers(0, 9))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(ROW, min_size=0, max_size=40), parts=st.integers(1, 5))
def test_keep_first_matches_brute_force(spark, rows, parts):
    data = [(k1, k2, v, i) for i, (k1, k2, v) in enumerate(rows)]
    pdf = pd.DataFrame(data, columns=["k1", "k2", "v", "_ord"], dtype=object)
    want = [tuple(r) for r in pdf.drop_duplicates(subset=["k1", "k2"], keep="first")
            .itertuples(index=False)]
    df = spark.createDataFrame(data, "k1 string, k2 int, v int, _ord long").repartition(parts)
    got = [tuple(r) for r in keep_first(df, ["k1", "k2"], ["_ord"]).collect()]
    norm = lambda rows: sorted((tuple(None if pd.isna(x) else x for x in r) for r in rows),
                               key=repr)
    assert norm(got) == norm(want)
