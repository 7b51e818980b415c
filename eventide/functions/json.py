"""JSON / VARIANT column helpers: paths, kinds, text, type names (FN-1..4, DISC-2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT32_MIN, INT32_MAX = -(2 ** 31), 2 ** 31 - 1


def split_path(path: str | None) -> list[str] | None:
    """Split a dotted path the way the reference does.

    ``None``/``""`` -> ``None`` (no path). Trailing empty parts are dropped
    (``"a."`` is ``["a"]``, ``"."`` is ``[]``); leading/inner empty parts stay.
    """
    if path is None or path == "":
        return None
    parts = path.split(".")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def variant_path(parts: list[str]) -> str:
    """Quoted VARIANT path for object keys only (no array indexing)."""
    out = "$"
    for p in parts:
        if "'" not in p:
            out += "['" + p.replace("\\", "\\\\") + "']"
        else:
            out += '["' + p.replace("\\", "\\\\").replace('"', '\\"') + '"]'
    return out


def get_path(v: Column, parts: list[str]) -> Column:
    """MAP-2: walk objects only; anything else on the way gives NULL."""
    if not parts:
        return v
    return F.try_variant_get(v, variant_path(parts), "variant")


def present(v: Column) -> Column:
    """Neither SQL NULL nor JSON null."""
    return v.isNotNull() & ~F.is_variant_null(v)


def kind_of_schema(s: Column) -> Column:
    """object / array / string / boolean / null / number from a VARIANT schema string."""
    return (F.when(s.startswith("OBJECT"), "object").when(s.startswith("ARRAY"), "array")
            .when(s == "STRING", "string").when(s == "BOOLEAN", "boolean").when(s == "VOID", "null")
            .otherwise("number"))


def kind(v: Column) -> Column:
    """object / array / string / boolean / null / number of a VARIANT value."""
    return kind_of_schema(F.schema_of_variant(v))


def is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def is_fraction(s: Column) -> Column:
    """Whether a VARIANT schema string is that of a number written with a point (see ``conversions.is_fraction``)."""
    return s.startswith("DECIMAL(") & ~s.rlike(r"^DECIMAL[(](19|[2-9][0-9]),0[)]$")


def as_read(v: Column) -> Column:
    """A JSON value; a number with a point as the double it is."""
    return F.when(is_fraction(F.schema_of_variant(v)), F.try_variant_get(v, "$", "double").cast("variant")).otherwise(v)


def as_text(v: Column) -> Column:
    """Scalar text of a JSON value; ``""`` for objects and arrays."""
    k = kind(v)
    return F.when(k.isin("object", "array"), F.lit("")).otherwise(as_read(v).cast("string"))


# Fixed value: the JVM String.trim set, every char from U+0000 to U+0020.
JVM_TRIM_CHARS = "".join(chr(c) for c in range(0x21))


def jtrim(s: Column) -> Column:
    """Trim every char <= U+0020 at both ends (JVM String.trim), no regex."""
    return F.trim(s, F.lit(JVM_TRIM_CHARS))


def as_variant(c: Column) -> Column:
    return c.cast("variant")


def type_name(v: Column, s: Column | None = None) -> Column:
    """DISC-2: reference type names from the VARIANT schema ``s`` of ``v``.

    ints within 32 bits -> integer, other ints -> long, fractions/exponents ->
    double, a 19+ digit integer -> unknown.
    """
    if s is None:
        s = F.schema_of_variant(v)
    dec_scale0 = s.rlike(r"^DECIMAL\(\d+,0\)$")
    dec_prec = F.regexp_extract(s, r"^DECIMAL\((\d+),", 1).cast("int")
    as_long = F.try_variant_get(v, "$", "bigint")
    return (F.when(s == "STRING", "string")
            .when(s == "BIGINT", F.when(as_long.between(INT32_MIN, INT32_MAX), "integer").otherwise("long"))
            .when(s.isin("DOUBLE", "FLOAT"), "double")
            .when(dec_scale0 & (dec_prec > 18), "unknown")
            .when(s.startswith("DECIMAL"), "double")
            .when(s == "BOOLEAN", "boolean")
            .when(s.startswith("ARRAY"), "array")
            .when(s.startswith("OBJECT"), "object")
            .when(s == "VOID", "null")
            .otherwise("unknown"))


def unwrap_payload(v: Column) -> Column:
    """FN-4: the record's ``payload`` member when the key exists, else the record."""
    return F.coalesce(F.try_variant_get(v, "$['payload']", "variant"), v)


def now_iso() -> Column:
    """Current time as ISO offset text (UTC prints as ``Z``)."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
