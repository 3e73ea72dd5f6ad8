"""DuckDB reference SQL for every table builder (verification only).

The Spark builders in :mod:`tradelake.plans.build` are checked against this
independent SQL formulation of the same rules: landed frames (the shared
landing SQL of :mod:`tradelake.sources.driver`), parent join, filters, text
rules, coercions written with DuckDB functions, ``QUALIFY ROW_NUMBER()`` for
keep-first.  Table names are the driver's pre-registered views.
"""

from __future__ import annotations

from .operators.clean import FALSE_WORDS, INVENTORY_KIND_LABELS, TRUE_WORDS
from .plans.build import cast_columns, output_columns
from .plans.specs import SPEC_BY_NAME
from .sources.driver import FRAMES, frame_sql
from .sources.export import path_depth, ref_width

_NUM = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INF = r"^[+-]?(inf|infinity)$"


def _q(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _int(x: str) -> str:
    d = f"TRY_CAST({_strip(x)} AS DECIMAL(38,18))"
    v = f"TRY_CAST({_strip(x)} AS DOUBLE)"
    return (f"(CASE WHEN NOT regexp_full_match({x}, '{_NUM}') THEN NULL "
            f"WHEN {d} IS NOT NULL THEN (CASE WHEN {d} = floor({d}) AND {v} = floor({v}) "
            f"THEN TRY_CAST({d} AS BIGINT) END) "
            f"WHEN isfinite({v}) AND {v} = floor({v}) AND abs({v}) < 9223372036854775807 "
            f"THEN TRY_CAST({v} AS BIGINT) END)")


def _float(x: str) -> str:
    v = f"TRY_CAST({_strip(x)} AS DOUBLE)"
    return (f"(CASE WHEN regexp_full_match({x}, '{_NUM}') THEN "
            f"(CASE WHEN isfinite({v}) THEN {v} END) "
            f"WHEN regexp_full_match(lower({x}), '{_INF}') THEN "
            f"(CASE WHEN {x} LIKE '-%' THEN CAST('-inf' AS DOUBLE) "
            f"ELSE CAST('inf' AS DOUBLE) END) END)")


def _bool(x: str) -> str:
    u = f"upper({_strip(x)})"
    return (f"(CASE WHEN {u} IN ({_q(TRUE_WORDS)}) THEN TRUE "
            f"WHEN {u} IN ({_q(FALSE_WORDS)}) THEN FALSE END)")


def _filtered(name: str) -> tuple[str, tuple[str, ...]]:
    """Raw rows of the table that its casts see."""
    spec = SPEC_BY_NAME[name]
    fd = FRAMES[spec.source][spec.path]
    refs = fd.refs
    have = set(fd.columns)
    sel = [f"f.{r}" for r in refs]
    first_field = spec.first_of[1] if spec.first_of else None
    for c in spec.read_fields:
        if c in spec.inherited or c == first_field:
            continue
        sel.append(f"f.{c}" if c in have else f"CAST(NULL AS VARCHAR) AS {c}")
    src = f"({frame_sql(spec.source, spec.path)}) f"

    if spec.first_of:
        cpath, fld = spec.first_of
        cfd = FRAMES[spec.source][cpath]
        pos = [r for r in cfd.refs if r not in refs]
        part = ", ".join(refs)
        src += (f" LEFT JOIN (SELECT {part}, {fld} FROM ({frame_sql(spec.source, cpath)}) "
                f"QUALIFY row_number() OVER (PARTITION BY {part} ORDER BY {', '.join(pos)}) = 1) h "
                f"ON " + " AND ".join(f"f.{r} = h.{r}" for r in refs))
        sel.append(f"h.{fld}")

    if spec.parent:
        psql, prefs = _with_refs(spec.parent)
        width = ref_width(refs, path_depth(SPEC_BY_NAME[spec.parent].path))
        assert tuple(refs[:width]) == prefs
        src += (f" JOIN ({psql}) p ON " + " AND ".join(f"f.{r} = p.{r}" for r in prefs))
        sel += [f"p.{c}" for c in spec.inherited]

    where = []
    if spec.active:
        where.append("f.state = 'A'")
    if spec.active_or_blank:
        where.append("f.state IN ('A', '')")
    for t in spec.truthy:
        where.append(f"(f.{t} IS NOT NULL AND f.{t} <> '')")
    inner = f"SELECT {', '.join(sel)} FROM {src}"
    if where:
        inner += " WHERE " + " AND ".join(where)
    return inner, refs


def _with_refs(name: str) -> tuple[str, tuple[str, ...]]:
    spec = SPEC_BY_NAME[name]
    inner, refs = _filtered(name)
    ex = {}
    for c in spec.strip:
        ex[c] = _strip(c)
    for c in spec.blank_null:
        ex[c] = f"NULLIF({_strip(c)}, '')"
    for c in spec.strip_truthy:
        ex[c] = f"(CASE WHEN {c} IS NOT NULL AND {c} <> '' THEN {_strip(c)} END)"
    for c in spec.upper:
        ex[c] = f"upper({_strip(c)})"
    for c in spec.default_blank:
        ex[c] = f"COALESCE({c}, '')"
    for c in spec.typed("long"):
        ex[c] = _int(c)
    for c in spec.typed("double"):
        ex[c] = _float(c)
    for c in spec.typed("boolean"):
        ex[c] = _bool(c)
    cols = ", ".join([*refs, *[f"{ex.get(c, c)} AS {c}" for c in spec.columns]])
    sql = f"SELECT {cols} FROM ({inner}) r"

    outer_where = " AND ".join(f"{c} IS NOT NULL" for c in spec.dropna)
    sql = f"SELECT * FROM ({sql}) c" + (f" WHERE {outer_where}" if outer_where else "")
    if spec.key is not None:
        sql += (f" QUALIFY row_number() OVER (PARTITION BY {', '.join(spec.key)} "
                f"ORDER BY {', '.join(refs)}) = 1")
    if spec.distinct:
        sql = f"SELECT DISTINCT {', '.join(refs)}, {', '.join(spec.columns)} FROM ({sql}) d"
        # refs differ per row; de-duplicate on business columns only
        sql = (f"SELECT * FROM ({sql}) d QUALIFY row_number() OVER "
               f"(PARTITION BY {', '.join(spec.columns)} ORDER BY {', '.join(refs)}) = 1")
    if spec.label:
        cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in INVENTORY_KIND_LABELS.items())
        sql = f"SELECT *, (CASE inventory_kind {cases} END) AS label FROM ({sql}) l"
    return sql, refs


def table_sql(name: str) -> str:
    sql, _ = _with_refs(name)
    return f"SELECT {', '.join(output_columns(name))} FROM ({sql}) t"


def rejects_sql(names: list[str]) -> str:
    """Per integer column: numbers that are no bigint."""
    out = []
    for name in names:
        inner, _ = _filtered(name)
        for c in cast_columns(name):
            finite = f"(regexp_full_match({c}, '{_NUM}') AND isfinite(TRY_CAST({_strip(c)} AS DOUBLE)))"
            bad = (f"coalesce(({finite} OR regexp_full_match(lower({c}), '{_INF[1:-1]}')) "
                   f"AND {_int(c)} IS NULL, false)")
            out.append(f"SELECT '{name}' AS \"table\", '{c}' AS \"column\", COUNT(*) FILTER ({bad}) AS n_rejects "
                       f"FROM ({inner}) r")
    return " UNION ALL ".join(out)


def window_sql(name: str, days: int) -> str:
    """Table ``name`` of the visits with a header in the last ``days`` days."""
    sql, _ = _with_refs(name)
    headers = frame_sql("visit", "visit_headers")
    return (f"WITH d AS (SELECT max(CAST(ts AS DATE)) AS last FROM events) "
            f"SELECT {', '.join(output_columns(name))} FROM ({sql}) t WHERE _ord IN (SELECT _ord FROM ({headers}) h, d "
            f"WHERE CAST(visit_date AS DATE) BETWEEN last - {days} AND last)")


# -- measures (D1m–D12m) ---------------------------------------------------------

def _orders_cte() -> str:
    return (f"o AS ({table_sql('orders')}), "
            "od AS (SELECT *, TRY_CAST(total_amount AS DECIMAL(38,2)) AS amt FROM o), "
            "mb AS (SELECT filial_code, month, SUM(amt) AS sales FROM "
            "(SELECT filial_code, strftime(TRY_CAST(deal_time AS DATE), '%Y-%m') AS month, amt "
            "FROM od) x WHERE month IS NOT NULL GROUP BY filial_code, month)")


_SALES = ("COUNT(*) AS n_orders, CAST(SUM(amt) AS DOUBLE) AS total_sales, "
          "CAST(SUM(amt) AS DOUBLE) / CAST(COUNT(amt) AS DOUBLE) AS avg_sales")
_WB = "PARTITION BY filial_code ORDER BY month"


def measure_sql(name: str) -> str:
    body = {
        "d1_total_sales": "SELECT currency_code, CAST(SUM(amt) AS DOUBLE) AS total_sales "
                          "FROM od GROUP BY currency_code",
        "d2_average_sales": "SELECT CAST(SUM(amt) AS DOUBLE) / CAST(COUNT(amt) AS DOUBLE) "
                            "AS avg_sales FROM od",
        "d3_total_orders": "SELECT COUNT(*) AS n_orders FROM od",
        "d4_returned_orders": (
            f"SELECT filial_code, COUNT(*) AS n_orders, COUNT(r.rid) AS n_returned FROM od "
            f"LEFT JOIN (SELECT DISTINCT order_deal_id AS rid FROM ({table_sql('returns')}) rr "
            f"WHERE order_deal_id IS NOT NULL) r ON od.deal_id = r.rid GROUP BY filial_code"),
        "d5_sales_by_branch": f"SELECT filial_code, {_SALES} FROM od GROUP BY filial_code",
        "d6_sales_by_manager": f"SELECT sales_manager_id, {_SALES} FROM od "
                               f"GROUP BY sales_manager_id",
        "d7_trade_dynamics": (
            f"SELECT filial_code, month, CAST(sales AS DOUBLE) AS sales, "
            f"CAST(LAG(sales) OVER ({_WB}) AS DOUBLE) AS prev_sales, "
            f"CAST(sales - LAG(sales) OVER ({_WB}) AS DOUBLE) AS change FROM mb"),
        "d8_top_branches": (
            "SELECT filial_code, CAST(sales AS DOUBLE) AS total_sales, "
            "row_number() OVER (ORDER BY sales DESC NULLS LAST, filial_code ASC NULLS FIRST) "
            "AS rank FROM (SELECT filial_code, SUM(amt) AS sales FROM od GROUP BY filial_code) a "
            "QUALIFY rank <= 10"),
        "d9_contribution": (
            "SELECT filial_code, CAST(sales AS DOUBLE) AS total_sales, "
            "CAST(sales AS DOUBLE) / CAST((SELECT SUM(amt) FROM od) AS DOUBLE) AS share "
            "FROM (SELECT filial_code, SUM(amt) AS sales FROM od GROUP BY filial_code) a"),
        "d10_moving_average": (
            f"SELECT filial_code, month, CAST(sales AS DOUBLE) AS sales, "
            f"CAST(SUM(sales) OVER ({_WB} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE) / "
            f"CAST(COUNT(sales) OVER ({_WB} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE) "
            f"AS moving_avg FROM mb"),
        "d11_cumulative_sales": (
            f"SELECT filial_code, month, CAST(sales AS DOUBLE) AS sales, "
            f"CAST(SUM(sales) OVER ({_WB} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
            f"AS DOUBLE) AS cumulative_sales FROM mb"),
        "d12_sales_anomalies": (
            f"SELECT filial_code, month, CAST(sales AS DOUBLE) AS sales FROM ("
            f"SELECT filial_code, month, sales, x, "
            f"COUNT(x) OVER ({_WB} ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS n, "
            f"SUM(x) OVER ({_WB} ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS s, "
            f"SUM(x * x) OVER ({_WB} ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS q "
            f"FROM (SELECT *, CAST(sales * 100 AS HUGEINT) AS x FROM mb) c) z "
            f"WHERE n >= 2 AND (n - 1) * (n * x - s) * (n * x - s) > 4 * n * (n * q - s * s)"),
        "unmeasured_orders": (
            "SELECT filial_code, COUNT(*) AS n_orders, "
            "COUNT(*) FILTER (total_amount IS NOT NULL AND amt IS NULL) AS n_amount_unsummable, "
            "COUNT(*) FILTER (TRY_CAST(deal_time AS DATE) IS NULL) AS n_time_unparsed, "
            "CAST(SUM(amt) FILTER (TRY_CAST(deal_time AS DATE) IS NULL) AS DOUBLE) "
            "AS sales_time_unparsed FROM od GROUP BY filial_code"),
    }[name]
    return f"WITH {_orders_cte()} {body}"


#: The fields that ``driver.write_with_new_fields`` adds, counted per document.
UNDECLARED_FIELDS = """
SELECT 'priority text' AS path, count(*) FILTER (o_orderpriority IS NOT NULL) AS documents, 'STRING' AS types FROM orders
UNION ALL SELECT 'urgent', count(*) FILTER (o_orderpriority = '1-URGENT'), 'OBJECT' FROM orders
UNION ALL SELECT 'order_products.bonus_points', count(*) FILTER (o_orderstatus = 'F'), 'STRING' FROM orders
"""
