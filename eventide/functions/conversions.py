"""CONV-0..10: the closed set of field conversions as Catalyst expressions.

A conversion maps a present JSON value to ``(value VARIANT, error STRING or
NULL)``. A non-NULL error makes the whole event fail (RT-2); its text follows
the JVM number parser messages. Inputs arrive as a :class:`Val` whose parts
(kind, text, trimmed text) the mapping compiler has already materialised as
columns, so every conversion is a small expression over attributes.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.sqltext import lit

# Fixed patterns: JVM integer text, JVM floating text, ISO-8601 offset date-time.
INT_TEXT = r"^[+-]?[0-9]+$"
FLOAT_TEXT = r"^[+-]?(NaN|Infinity|(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)[fFdD]?)$"
ISO_OFFSET = (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?"
              r"(Z|[+-][0-9]{2}:[0-9]{2}(:[0-9]{2})?)$")


@dataclass
class Val:
    """A present value's parts, as SQL expressions (usually quoted column names)."""
    v: str    # VARIANT value (present)
    k: str    # kind: object/array/string/boolean/null/number
    t: str    # scalar text ("" for containers)
    tt: str   # text trimmed of chars <= U+0020
    s: str    # VARIANT schema string of v
    # Parts of numbers, for conversions that name them (see number_parts):
    l: str | None = None   # 64-bit whole number
    w: str | None = None   # whole number beyond 64 bits, modulo 2^bits
    d: str | None = None   # any other number, as a double


Expr = str | Column
Conv = Callable[[Val], tuple[Expr, Expr | None]]
_REGISTRY: dict[str, Conv] = {}
NEEDS_TEXT: set[str] = set()
_NUMBERS: dict[str, str] = {}


def register_conversion(name: str, fn: Conv, needs_text: bool = True, numbers: str | None = None) -> None:
    """Extension point: ``Val -> (VARIANT expr, error expr or None)``; each
    expr is SQL text or a ``Column``. With ``numbers`` (INT, BIGINT or DOUBLE, the
    result's type) numbers come as the parts l, w and d, without a text."""
    _REGISTRY[name] = fn
    _NUMBERS.pop(name, None)
    if numbers is not None:
        _NUMBERS[name] = numbers
    if needs_text:
        NEEDS_TEXT.add(name)


def is_fraction(s: str) -> str:
    """Whether a VARIANT schema string is that of a number written with a point: a decimal, but not one of 19 or more
    digits without a fraction, which is a whole number beyond 64 bits. (A number with an exponent is a DOUBLE.)"""
    return f"({s} LIKE 'DECIMAL(%' AND NOT {s} RLIKE {lit(r'^DECIMAL[(](19|[2-9][0-9]),0[)]$')})"


def scalar_text(v: str, k: str, s: str) -> str:
    """Scalar text of a JSON value as SQL: '' for containers; a number with a point is a double, so ``100.0`` keeps its form."""
    return (f"CASE WHEN {k} IN ('object', 'array') THEN '' WHEN {is_fraction(s)} "
            f"THEN CAST(try_variant_get({v}, '$', 'double') AS STRING) ELSE CAST({v} AS STRING) END")


def _as_read(x: Val) -> tuple[str, None]:
    """The value; a number with a point as the double it is (a decimal prints ``100.0`` as ``100``)."""
    return f"CASE WHEN {is_fraction(x.s)} THEN CAST(try_variant_get({x.v}, '$', 'double') AS VARIANT) ELSE {x.v} END", None


# Conversions are written as SQL text over the compiler's attribute names
# (``Val`` fields hold quoted column names); see functions/sqltext.py.
NOW_ISO_SQL = "date_format(current_timestamp(), " + lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX") + ")"


def _bad_input(tt: str) -> str:
    return f"concat('For input string: \"', {tt}, '\"')"


WIDE = r"^DECIMAL[(](19|[2-9][0-9]),0[)]$"


def number_parts(name: str | None, v: str, k: str, s: str) -> dict[str, str]:
    """The ``Val`` parts l, w and d of a number as SQL, each read from the VARIANT once; {} where a conversion needs none."""
    if name not in _NUMBERS:
        return {}
    bits = {"INT": 32, "BIGINT": 64}.get(_NUMBERS[name])
    if bits is None:
        return {"d": f"CASE WHEN {k} = 'number' THEN try_variant_get({v}, '$', 'double') END"}
    wide = f"(startswith({s}, 'DECIMAL(') AND {s} RLIKE {lit(WIDE)})"
    return {"l": f"CASE WHEN {s} = 'BIGINT' THEN try_variant_get({v}, '$', 'bigint') END",
            "w": f"CASE WHEN {wide} THEN pmod(try_variant_get({v}, '$', 'decimal(38,0)'), CAST('{2 ** bits}' AS DECIMAL(38,0))) END",
            "d": f"CASE WHEN {k} = 'number' AND {s} <> 'BIGINT' AND NOT {wide} THEN try_variant_get({v}, '$', 'double') END"}


def _integral(x: Val, bits: int) -> tuple[str, str]:
    to = "INT" if bits == 32 else "BIGINT"
    lo, hi = -(2 ** (bits - 1)), 2 ** (bits - 1) - 1
    mod, half = f"CAST('{2 ** bits}' AS DECIMAL(38,0))", f"CAST('{2 ** (bits - 1)}' AS DECIMAL(38,0))"
    low = x.l if bits == 64 else f"CAST(shiftright(shiftleft({x.l}, 32), 32) AS INT)"
    wrap = f"CAST(CASE WHEN {x.w} >= {half} THEN {x.w} - {mod} ELSE {x.w} END AS {to})"
    sat = (f"CASE WHEN isnan({x.d}) THEN CAST(0 AS {to}) WHEN {x.d} >= {float(hi)!r} THEN CAST({hi} AS {to}) "
           f"WHEN {x.d} <= {float(lo)!r} THEN CAST('{lo}' AS {to}) ELSE CAST({x.d} AS {to}) END")
    parsed = (f"CASE WHEN {x.tt} RLIKE {lit(INT_TEXT)} THEN "
              f"try_cast(regexp_replace({x.tt}, {lit('^[+]')}, '') AS {to}) END")
    out = (f"CAST(CASE WHEN {x.l} IS NOT NULL THEN {low} WHEN {x.w} IS NOT NULL THEN {wrap} "
           f"WHEN {x.k} = 'number' THEN {sat} ELSE {parsed} END AS VARIANT)")
    err = f"CASE WHEN {x.k} <> 'number' AND ({parsed}) IS NULL THEN {_bad_input(x.tt)} END"
    return out, err


def _to_double(x: Val) -> tuple[str, str]:
    parsed = (f"CASE WHEN {x.tt} RLIKE {lit(FLOAT_TEXT)} THEN "
              f"try_cast(regexp_replace({x.tt}, {lit('[fFdD]$')}, '') AS DOUBLE) END")
    out = f"CAST(CASE WHEN {x.k} = 'number' THEN {x.d} ELSE {parsed} END AS VARIANT)"
    err = (f"CASE WHEN {x.k} <> 'number' AND ({parsed}) IS NULL THEN "
           f"CASE WHEN {x.tt} = '' THEN 'empty String' ELSE {_bad_input(x.tt)} END END")
    return out, err


def _to_boolean(x: Val) -> tuple[str, None]:
    return (f"CAST(CASE WHEN {x.k} = 'boolean' THEN try_variant_get({x.v}, '$', 'boolean') "
            f"ELSE lower({x.tt}) = 'true' END AS VARIANT)"), None


def _to_timestamp(x: Val) -> tuple[str, None]:
    ok = f"({x.tt} RLIKE {lit(ISO_OFFSET)} AND try_to_timestamp({x.tt}) IS NOT NULL)"
    return f"CAST(CASE WHEN {ok} THEN {x.tt} ELSE {NOW_ISO_SQL} END AS VARIANT)", None


def _mask(x: Val) -> tuple[str, None]:
    return (f"CAST(CASE WHEN length({x.t}) <= 2 THEN '**' ELSE concat(substring({x.t}, 1, 1), "
            f"repeat('*', length({x.t}) - 2), substring({x.t}, -1, 1)) END AS VARIANT)"), None


register_conversion("NONE", _as_read, needs_text=False)
register_conversion("FLATTEN", _as_read, needs_text=False)  # objects: the compiler
register_conversion("TO_STRING", lambda x: (f"CAST({x.t} AS VARIANT)", None))
register_conversion("TO_INTEGER", lambda x: _integral(x, 32), numbers="INT")
register_conversion("TO_LONG", lambda x: _integral(x, 64), numbers="BIGINT")
register_conversion("TO_DOUBLE", _to_double, numbers="DOUBLE")
register_conversion("TO_BOOLEAN", _to_boolean)
register_conversion("TO_TIMESTAMP", _to_timestamp)
register_conversion("TO_UPPER", lambda x: (f"CAST(upper({x.t}) AS VARIANT)", None))
register_conversion("TO_LOWER", lambda x: (f"CAST(lower({x.t}) AS VARIANT)", None))
register_conversion("MASK", _mask)


def conversion(name: str | None) -> Conv:
    try:
        return _REGISTRY[name or "NONE"]
    except KeyError:
        raise ValueError(f"unknown conversion {name!r}") from None


def needs_text(name: str | None) -> bool:
    return (name or "NONE") in NEEDS_TEXT


def as_column(e: Expr | None) -> Column | None:
    if e is None or isinstance(e, Column):
        return e
    return F.expr(e)


def convert_column(df: DataFrame, col: str, name: str | None, out: str = "converted",
                   err: str = "convert_error") -> DataFrame:
    """Apply one conversion to a present VARIANT column of ``df``."""
    from eventide.functions.json import jtrim, kind_of_schema
    parts = df.withColumn("__cv_s", F.schema_of_variant(F.col(col)))
    parts = parts.withColumn("__cv_k", kind_of_schema(F.col("__cv_s")))
    parts = parts.withColumn("__cv_t", F.expr(scalar_text(f"`{col}`", "`__cv_k`", "`__cv_s`")))
    parts = parts.withColumn("__cv_tt", jtrim(F.col("__cv_t")))
    numbers = number_parts(name, f"`{col}`", "`__cv_k`", "`__cv_s`")
    parts = parts.withColumns({f"__cv_{p}": F.expr(x) for p, x in numbers.items()})
    o, e = conversion(name)(Val(f"`{col}`", "`__cv_k`", "`__cv_t`", "`__cv_tt`", "`__cv_s`",
                                *[f"`__cv_{p}`" if p in numbers else None for p in ("l", "w", "d")]))
    res = parts.withColumn(out, as_column(o)).withColumn(
        err, as_column(e) if e is not None else F.lit(None).cast("string"))
    return res.drop("__cv_s", "__cv_k", "__cv_t", "__cv_tt", *[f"__cv_{p}" for p in numbers])
