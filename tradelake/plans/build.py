"""Generic table builder: one export frame -> one clean table.

Plan per table (all DataFrame operators, planned by Catalyst):

1. read the frame's raw text fields (absent fields are NULL columns — O5/D1);
2. children (O12/O13): where the parent frame holds the child list, the list
   rides along with the parent row through the parent's filters and keep-first,
   and is exploded from the surviving row with the inherited (``^``) columns
   beside it — no join.  A parent without keep-first makes this narrow.  If no
   other table is built from it, a list that is shuffled with its parent holds
   only what the asked table reads.  Where
   the frames come from separate relational tables, an inner equi-join on the
   parent's reference columns does the same, on the rows a frame is a projection
   of where it gives them: the join then moves no text that is made from them;
3. row filters on raw text (O1–O4), text transforms (O16–O18, O21),
   coercion (O6–O8), NULL-key drop (O11);
4. keep-first (O9) over the reference columns or whole-row distinct (O10); a
   child's groups lie within one document, so the rows stay where the join
   brought them;
5. derived label (O19).

The result keeps the reference columns and, on request, the child lists;
:func:`table` strips them for output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..operators import clean as C
from ..operators.dedup import distinct_rows, drop_null_keys, keep_first
from ..session import tune_session
from ..sources.export import Export, path_depth, ref_width
from .specs import SPEC_BY_NAME, TableSpec


def _field(df: DataFrame, name: str, have: set[str] | None = None):
    """Column ``name``, or a NULL text column when the export lacks it.
    Pass ``have`` (the frame's column names) when asking for many fields."""
    have = set(df.columns) if have is None else have
    return F.col(name) if name in have else F.lit(None).cast("string").alias(name)


def _first_element(export: Export, depth_refs: tuple[str, ...], child_path: str,
                   field_name: str) -> DataFrame:
    """O15 over separate frames: per parent row, ``field`` of its first child
    element (NULL when the list is empty).  ``min(struct(position..., value))``
    is a partial aggregate, so a parent with many elements is reduced map-side."""
    fr = export.frame(child_path)
    pos = [r for r in fr.refs if r not in depth_refs]
    df = fr.df
    val = _field(df, field_name)
    return (df.groupBy(*depth_refs)
              .agg(F.min(F.struct(*[F.col(p) for p in pos], val.alias("_v"))).alias("_first"))
              .select(*depth_refs, F.col("_first._v").alias(field_name)))


def _struct_fields(df: DataFrame, column: str) -> set[str]:
    return set(df.schema[column].dataType.elementType.names)


def _explode(df: DataFrame, keep: list[str], steps: list[str], depth: int) -> DataFrame:
    """Elements of the list ``_list_<step>`` of each row, step by step, with the
    columns ``keep`` beside them.  NULL lists and elements give no row."""
    column = f"_list_{steps[0]}"
    for n, step in enumerate(steps, 1):
        pos = f"_p{depth + n}"
        df = (df.select(*keep, F.posexplode(F.col(column)).alias(pos, "_e"))
                .where(F.col("_e").isNotNull()))
        keep = [*keep, pos]
        if n < len(steps):
            column = steps[n]
            df = df.select(*keep, F.col(f"_e.{column}").alias(column))
    return df


def loses_rows(spec: TableSpec) -> bool:
    """Does the table, or a parent of it, de-duplicate (that is, shuffle)?"""
    own = spec.key is not None or spec.distinct
    return own or (spec.parent is not None and loses_rows(SPEC_BY_NAME[spec.parent]))


def lists_of(export: Export, name: str) -> tuple[str, ...]:
    """The child lists of table ``name`` that other tables explode."""
    spec = SPEC_BY_NAME[name]
    have = export.frame(spec.path).lists if spec.path in export.frames else None
    first = {_steps(spec, c)[0] for c in SPEC_BY_NAME.values() if c.parent == name}
    return tuple(sorted(f for f in first if have is None or f in have))


def _steps(parent: TableSpec, child: TableSpec) -> list[str]:
    """List fields that lead from the parent's frame to the child's."""
    return child.path[len(parent.path):].lstrip(".").split(".")


def _needs(name: str) -> dict[str, set[str]]:
    """By nesting path, the fields that table ``name`` and its parents read for it."""
    spec = SPEC_BY_NAME[name]
    needs = {spec.path: set(spec.read_fields)}
    while spec.parent:
        child, spec = spec, SPEC_BY_NAME[spec.parent]
        read = spec.read_fields if spec.distinct else [f for f in spec.read_fields if f not in spec.own]
        needs.setdefault(spec.path, set()).update(read, spec.truthy, spec.dropna, spec.key or (), child.inherited,
                                                  {"state"} if spec.active or spec.active_or_blank else ())
    return needs


def _slim(column: Column, element: StructType, path: str, needs: dict[str, set[str]]) -> Column:
    """The list ``column`` of ``element``s at ``path`` with the fields and lists that
    are needed; NULL elements keep their places."""
    def of(e: Column) -> Column:
        kept = []
        for f in element.fields:
            below = f"{path}.{f.name}"
            if isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StructType):
                if any(p == below or p.startswith(f"{below}.") for p in needs):
                    kept.append(_slim(e[f.name], f.dataType.elementType, below, needs).alias(f.name))
            elif f.name in needs.get(path, ()):
                kept.append(e[f.name].alias(f.name))
        return F.when(e.isNotNull(), F.struct(*kept)) if kept else e
    return F.transform(column, of)


def _rows(export: Export, spec: TableSpec, carry: tuple[str, ...], memo, only: str | None = None
          ) -> tuple[DataFrame, tuple[str, ...]]:
    """Raw rows of the table's frame whose parent survived: references, raw
    fields, inherited columns and the lists ``carry`` (as ``_list_<name>``), with
    what table ``only`` reads of them if it is the only one that is built."""
    first_field = spec.first_of[1] if spec.first_of else None
    fields = [f for f in spec.read_fields if f not in spec.inherited and f != first_field]
    if spec.parent:
        parent = SPEC_BY_NAME[spec.parent]
        steps = _steps(parent, spec)
        if steps[0] in export.frame(parent.path).lists:
            pdf, prefs = build_with_refs(export, spec.parent, memo, carry=(steps[0],), only=only)
            depth = path_depth(parent.path)
            df = _explode(pdf, [*prefs, *spec.inherited], steps, depth)
            refs = (*prefs, *[f"_p{depth + n}" for n in range(1, len(steps) + 1)])
            have = set(df.schema["_e"].dataType.names)

            def own(f):
                return (F.col(f"_e.{f}") if f in have else F.lit(None).cast("string")).alias(f)
            df = df.select(*refs, *spec.inherited, *[own(f) for f in fields],
                           *[F.col(f"_e.{c}").alias(f"_list_{c}") for c in carry])
            return df, refs

    fr = export.frame(spec.path)
    if spec.parent and fr.source is not None and not spec.first_of:
        return _source_rows(export, spec, fields, carry, memo)
    refs, raw = fr.refs, fr.df
    have = set(raw.columns)

    def carried(c: str) -> Column:
        if only is None or not loses_rows(spec):
            return F.col(c)
        return _slim(F.col(c), raw.schema[c].dataType.elementType, f"{spec.path}.{c}".lstrip("."), _needs(only))
    cols = [*refs, *[_field(raw, f, have) for f in fields],
            *[carried(c).alias(f"_list_{c}") for c in carry]]
    if spec.first_of and spec.first_of[0] in fr.lists:               # O15, in the row
        child, fname = spec.first_of
        element = F.get(F.filter(F.col(child), lambda e: e.isNotNull()), F.lit(0))
        value = element[fname] if fname in _struct_fields(raw, child) else F.lit(None).cast("string")
        cols.append(value.alias(fname))
    df = raw.select(*cols)
    if spec.first_of and spec.first_of[0] not in fr.lists:
        first = _first_element(export, refs, *spec.first_of)
        df = df.join(first, on=list(refs), how="left")
    if spec.parent:
        pdf, prefs = build_with_refs(export, spec.parent, memo)
        prefix = tuple(refs[: ref_width(refs, path_depth(SPEC_BY_NAME[spec.parent].path))])
        assert prefix == prefs, (spec.name, prefix, prefs)
        inherited = pdf.select(*prefs, *spec.inherited)
        df = df.join(inherited, on=list(prefs), how="inner")
    return df, refs


def _source_rows(export: Export, spec: TableSpec, fields: list[str], carry: tuple[str, ...], memo
                 ) -> tuple[DataFrame, tuple[str, ...]]:
    """:func:`_rows` of a child frame that is a projection of its ``source``:
    the source rows are joined with the parent and projected behind the join."""
    fr = export.frame(spec.path)
    pdf, prefs = build_with_refs(export, spec.parent, memo)
    assert fr.parent_refs(path_depth(SPEC_BY_NAME[spec.parent].path)) == prefs, (spec.name, fr.refs, prefs)
    on = [f"_on{r}" for r in prefs]
    rows = fr.source.select("*", *[F.expr(fr.exprs[r]).alias(o) for r, o in zip(prefs, on)])
    inherited = pdf.select(*[F.col(r).alias(o) for r, o in zip(prefs, on)],
                           *[F.col(c).alias(f"_in_{c}") for c in spec.inherited])
    df = rows.join(inherited, on=on, how="inner")

    def own(f):
        return (F.expr(fr.exprs[f]) if f in fr.exprs else F.lit(None).cast("string")).alias(f)
    own_refs = [F.col(f"_on{r}").alias(r) if r in prefs else own(r) for r in fr.refs]
    df = df.select(*own_refs, *[F.col(f"_in_{c}").alias(c) for c in spec.inherited],
                   *[own(f) for f in fields], *[F.expr(fr.exprs[c]).alias(f"_list_{c}") for c in carry])
    return df, fr.refs


def _document_refs(spec: TableSpec, refs: tuple[str, ...]) -> tuple[str, ...]:
    """The references of a child's document, where the table's key (or its
    columns, if distinct) holds the key of its de-duplicated parent.  Such a key
    names one parent row, so it names one document: with the references added
    it means the same groups, and rows that the join has brought together by
    document are not shuffled once more."""
    parent = SPEC_BY_NAME[spec.parent] if spec.parent else None
    if parent is None or parent.key is None:
        return ()
    held = set(spec.inherited) & set(spec.columns if spec.distinct else spec.key or ())
    return refs[: ref_width(refs, 0)] if set(parent.key) <= held else ()


def filtered_rows(export: Export, name: str, carry: tuple[str, ...] = (), memo=None, only: str | None = None
                  ) -> tuple[DataFrame, tuple[str, ...]]:
    """Raw rows of table ``name`` after the parent and the row filters, before
    any coercion: the values that the table's casts see."""
    spec: TableSpec = SPEC_BY_NAME[name]
    df, refs = _rows(export, spec, carry, {} if memo is None else memo, only)
    # -- row filters on raw text
    cond = F.lit(True)
    if spec.active:
        cond = cond & C.is_active("state")
    if spec.active_or_blank:
        cond = cond & C.is_active_or_blank("state")
    for t in spec.truthy:
        cond = cond & C.is_truthy(t)
    if spec.active or spec.active_or_blank or spec.truthy:
        df = df.filter(cond)
    return df, refs


def build_with_refs(export: Export, name: str, memo: dict[str, tuple[DataFrame, tuple[str, ...]]] | None = None,
                    carry: tuple[str, ...] = (), seen: Observation | None = None, only: str | None = None
                    ) -> tuple[DataFrame, tuple[str, ...]]:
    """Build table ``name`` from ``export``; returns (DataFrame incl. refs and
    the lists ``carry``, refs).  ``memo`` holds tables that are already built
    (or written), with all lists they were built with.  ``seen`` observes the
    table's rejects (D2) in the pass that builds it.  ``only`` is the table that
    ``memo`` serves, if there is no other; the lists then hold what it reads."""
    memo = {} if memo is None else memo
    lists = [f"_list_{c}" for c in carry]
    if name in memo and set(lists) <= set(memo[name][0].columns):
        return memo[name]
    spec: TableSpec = SPEC_BY_NAME[name]
    df, refs = filtered_rows(export, name, carry, memo, only)
    ints = cast_columns(name)
    if seen is not None and ints:
        df = df.observe(seen, *[F.count_if(C.int_reject(c)).alias(c) for c in ints])

    # -- text transforms and coercion
    exprs = {}
    for c in spec.strip:
        exprs[c] = C.strip(c)
    for c in spec.blank_null:
        exprs[c] = C.strip_blank_null(c)
    for c in spec.strip_truthy:
        exprs[c] = C.strip_if_truthy(c)
    for c in spec.upper:
        exprs[c] = C.strip_upper(c)
    for c in spec.default_blank:
        exprs[c] = C.default_blank(c)
    for c in spec.typed("long"):
        exprs[c] = C.to_int(c)
    for c in spec.typed("double"):
        exprs[c] = C.to_float(c)
    for c in spec.typed("boolean"):
        exprs[c] = C.to_bool(c)
    df = df.select(*refs, *[exprs.get(c, F.col(c)).alias(c) for c in spec.columns], *lists)

    df = drop_null_keys(df, spec.dropna)
    home = _document_refs(spec, refs)
    if home:
        tune_session(df.sparkSession)
    if spec.key is not None:
        df = keep_first(df, [*home, *spec.key], refs)
    if spec.distinct:
        df = distinct_rows(df, [*home, *spec.columns])
    if spec.label:
        df = df.withColumn("label", C.inventory_kind_label("inventory_kind"))

    memo[name] = (df, refs)
    return df, refs


def output_columns(name: str) -> list[str]:
    spec = SPEC_BY_NAME[name]
    return spec.columns + (["label"] if spec.label else [])


def table(export: Export, name: str, memo=None) -> DataFrame:
    """Table ``name`` as written: business columns only, in reference order."""
    df, _ = build_with_refs(export, name, memo, only=name if memo is None else None)
    return df.select(*output_columns(name))


def cast_columns(name: str) -> list[str]:
    """The columns that table ``name`` itself casts to integers."""
    spec = SPEC_BY_NAME[name]
    return [c for c in spec.typed("long") if c not in spec.inherited]


def rejects(export: Export, name: str, memo=None) -> DataFrame:
    """Per integer column of table ``name``, how many values that its cast
    sees (rows whose parent survived and that pass the row filters) looked
    numeric but could not become a bigint (fraction, infinity, overflow).  The
    reference aborts the whole run on the first such value; we keep NULL in
    the table and report the count.  One aggregate, no collect; callers decide
    (``strict`` runs raise on a non-zero count)."""
    ints = cast_columns(name)
    df, _ = filtered_rows(export, name, memo=memo)
    if not ints:
        return df.sparkSession.createDataFrame([], "table string, column string, n_rejects long")
    wide = df.agg(*[F.count_if(C.int_reject(c)).alias(c) for c in ints])
    stack = ", ".join(f"'{c}', `{c}`" for c in ints)
    return wide.selectExpr(f"'{name}' AS table", f"stack({len(ints)}, {stack}) AS (column, n_rejects)")
