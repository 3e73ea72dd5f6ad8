"""Row/column cleaning operators.

Every rule is one Spark SQL expression over a column name (``F.expr``), so
it stays inside whole-stage codegen (no Python UDF anywhere), and building a
table with dozens of coerced columns costs the driver one call per column
instead of one per sub-expression.  ANSI mode is on in Spark 4, so every
cast is a ``try_cast`` and never raises on bad input.

Patterns are written without backslashes (character classes of literal
characters), so they mean the same under either setting of
``spark.sql.parser.escapedStringLiterals``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace a number parser skips around a number.
ASCII_SPACE = " \t\n\r\f\v"
# Whitespace a Python ``str.strip()`` removes (the reference strips with it),
# derived from the Unicode database rather than listed by hand.
UNICODE_SPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

_WS = f"[{ASCII_SPACE}]"
# A number as text: optional sign, digits with optional fraction (or a bare
# fraction), optional exponent, surrounded by optional ASCII whitespace.
NUMBER_PATTERN = f"^{_WS}*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?{_WS}*$"
# Infinity spelled out (kept as +/-inf by float coercion): any case, but no
# surrounding whitespace (pandas' ``to_numeric`` gives NaN for " inf ").
INF_PATTERN = "^[+-]?(?i:inf|infinity)$"

# Boolean spellings (after strip + upper) that must match the
# reference's tri-state mapping exactly.
TRUE_WORDS = ("1", "TRUE", "T", "YES")
FALSE_WORDS = ("0", "FALSE", "F", "NO")

# Inventory kind code -> label (product_inventory_kind.label).
INVENTORY_KIND_LABELS = {
    "G": "Goods (tovar)",
    "M": "Material (material)",
    "P": "Product (tayyor mahsulot)",
    "E": "Equipment (asbob-uskuna)",
    "S": "Service (xizmat)",
}

_NUMBER_CHARS = "0123456789+-.eE" + ASCII_SPACE
_INTEGER_CHARS = "0123456789+-" + ASCII_SPACE
_INF_WORDS = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")


# -- SQL text helpers ----------------------------------------------------------

def _lit(s: str) -> str:
    """A SQL string literal (our fixed texts contain no quote or backslash)."""
    assert "'" not in s and "\\" not in s, s
    return f"'{s}'"


def _in(words) -> str:
    return ", ".join(_lit(w) for w in words)


def _has_digit(x: str) -> str:
    return f"translate({x}, '0123456789', '') <> {x}"


def _text(name: str) -> str:
    """The column as text (leaves are text; a typed column is rendered)."""
    return f"CAST(`{name}` AS STRING)"


def _strip_sql(x: str) -> str:
    return f"TRIM(BOTH {_lit(UNICODE_SPACE)} FROM {x})"


def _int_sql(x: str) -> str:
    d = f"try_cast(TRIM(BOTH {_lit(ASCII_SPACE)} FROM {x}) AS DECIMAL(38,18))"
    v = f"try_cast({x} AS DOUBLE)"
    plain = f"(translate({x}, {_lit(_INTEGER_CHARS)}, '') = '' AND {_has_digit(x)})"
    integral_double = f"CAST(try_cast({v} AS BIGINT) AS DOUBLE) = {v}"
    # 1. plain integer; 2. exact decimal, integral values only (the double
    # must be integral too: the decimal's 18 places round '4e-19' to 0);
    # 3. a number the decimal cannot hold (e.g. '0E68'): its double, when
    # integral and in range (what the reference's float-then-Int64 gives).
    return (f"coalesce(CASE WHEN {plain} THEN try_cast({x} AS BIGINT) END, "
            f"CASE WHEN {x} RLIKE {_lit(NUMBER_PATTERN)} THEN "
            f"CASE WHEN {d} IS NOT NULL THEN "
            f"CASE WHEN {d} = floor({d}) AND {integral_double} THEN try_cast({d} AS BIGINT) END "
            f"WHEN {integral_double} THEN try_cast({v} AS BIGINT) END END)")


def _expr(sql: str) -> Column:
    return F.expr(sql)


# -- filters -------------------------------------------------------------------

def is_active(c: str = "state") -> Column:
    """O1/O2: ``state == 'A'``; NULL state is dropped."""
    return _expr(f"coalesce(`{c}` = 'A', false)")


def is_active_or_blank(c: str = "state") -> Column:
    """O3: ``state`` is ``'A'`` or ``''``; NULL dropped."""
    return _expr(f"coalesce(`{c}` IN ('A', ''), false)")


def is_truthy(c: str) -> Column:
    """Key is present and non-empty (whitespace-only is kept)."""
    return _expr(f"(`{c}` IS NOT NULL AND `{c}` <> '')")


# -- text ----------------------------------------------------------------------

def strip(c: str) -> Column:
    """Remove all Unicode whitespace at both ends (``trim`` with a
    character set: no regex, stays in codegen)."""
    return _expr(_strip_sql(f"`{c}`"))


def strip_blank_null(c: str) -> Column:
    """Strip, and an empty result becomes NULL."""
    return _expr(f"nullif({_strip_sql(f'`{c}`')}, '')")


def strip_if_truthy(c: str) -> Column:
    """Strip a present non-empty value; NULL or empty becomes NULL.  A
    whitespace-only value strips to ``''`` and stays ``''``."""
    return _expr(f"CASE WHEN `{c}` IS NOT NULL AND `{c}` <> '' "
                 f"THEN {_strip_sql(f'`{c}`')} END")


def strip_upper(c: str) -> Column:
    """Normalised code (strip + upper)."""
    return _expr(f"upper({_strip_sql(f'`{c}`')})")


def default_blank(c: str) -> Column:
    """A missing value reads as ``''``."""
    return _expr(f"coalesce(`{c}`, '')")


def inventory_kind_label(c: str) -> Column:
    """Constant map lookup; unknown code gives NULL."""
    pairs = ", ".join(f"{_lit(k)}, {_lit(v)}" for k, v in INVENTORY_KIND_LABELS.items())
    return _expr(f"try_element_at(map({pairs}), `{c}`)")


# -- coercion ------------------------------------------------------------------

def to_float(c: str) -> Column:
    """Text -> double.  Junk and empty give NULL, ``nan`` gives NULL,
    ``inf``/``infinity`` (any case, unpadded) are kept, a finite spelling
    that overflows a double (``1e999``) gives NULL.  Spark's own cast also
    accepts ``5d``/``5f`` suffixes and hex floats, so a value is only cast
    when it is made of number characters (a ``translate``, no regex) or is an
    infinity word."""
    x = _text(c)
    v = f"try_cast({x} AS DOUBLE)"
    return _expr(
        f"CASE WHEN translate({x}, {_lit(_NUMBER_CHARS)}, '') = '' AND {_has_digit(x)} "
        f"AND abs({v}) <> CAST('Infinity' AS DOUBLE) THEN {v} "
        f"WHEN lower({x}) IN ({_in(_INF_WORDS)}) THEN {v} END")


def to_int(c: str) -> Column:
    """Text -> bigint.  Accepts what a float parser accepts
    (``' 12 '``, ``'+7'``, ``'1e3'``, ``'1.0'``), exactly (no detour via double,
    so 2^53+1 survives).  Fractional, infinite, NaN or out-of-range values give
    NULL (see :func:`int_reject` to count them).

    Fast path: Spark's integer cast takes plain (signed, padded) integers.  It
    is only tried on text made of sign, digit and space characters with at
    least one digit (``translate`` checks): a *failing* string-to-bigint cast
    costs about 20 times a successful one, and fractions, junk and blanks
    would all pay it.  Other
    spellings go through the pattern check and an exact decimal."""
    return _expr(_int_sql(_text(c)))


def int_reject(c: str) -> Column:
    """True where a value is a number but cannot be a bigint (fraction,
    infinity, beyond bigint range): where the reference's Int64 conversion
    aborts the whole run.  A spelling beyond double range (``1e999``) is not
    a reject: it reads as NaN there, i.e. NULL.  We keep NULL and let callers
    count these rows."""
    x = _text(c)
    finite = (f"({x} RLIKE {_lit(NUMBER_PATTERN)} "
              f"AND abs(try_cast({x} AS DOUBLE)) <> CAST('Infinity' AS DOUBLE))")
    return _expr(f"coalesce(({finite} OR {x} RLIKE {_lit(INF_PATTERN)}) "
                 f"AND {_int_sql(x)} IS NULL, false)")


def to_bool(c: str) -> Column:
    """Tri-state boolean from text."""
    u = f"upper({_strip_sql(_text(c))})"          # no regex: trim + upper + IN
    return _expr(f"CASE WHEN {u} IN ({_in(TRUE_WORDS)}) THEN true "
                 f"WHEN {u} IN ({_in(FALSE_WORDS)}) THEN false END")
