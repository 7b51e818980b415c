"""DISC-1..4, AGG-10/11: payload schema discovery as DataFrame jobs.

Level-wise walk inside the row: level 1 is the array of the members of a
payload object; level *k+1* holds the members of the objects of level *k* (or
of the first element of an array, when that element is an object, with ``[*]``
in the path). The walk is a fixpoint of its own row: it goes on while the last
level has members, at most once per object of the payload, so one read of the
table finds paths of any depth and nothing runs while the plan is built. All
members leave by one ``explode``, and events are merged by a partially
aggregated ``groupBy(path)``. A caller that knows the depth may give it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.json import type_name


def _obj(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


_MEMBERS = "array<struct<path:string,ord:string,value:variant>>"


def _children(e: Column) -> Column:
    """Members of an object, or of the object that is an array's first element."""
    obj = _obj(e["value"])
    first = _obj(F.try_variant_get(e["value"], "$[0]", "variant"))
    sep = F.when(obj.isNotNull(), F.lit(".")).otherwise(F.lit("[*]."))
    return F.coalesce(F.transform(F.map_entries(F.coalesce(obj, first)), lambda x: F.struct(
        F.concat(e["path"], sep, x["key"]).alias("path"),
        F.concat(e["ord"], F.lit("\0"), x["key"]).alias("ord"), x["value"].alias("value"))),
        F.array().cast(_MEMBERS))


def _members(payload: Column, depth: int | None) -> Column:
    """All members of a payload (of the first ``depth`` levels, if given) as one array."""
    top = F.coalesce(F.transform(F.map_entries(_obj(payload)), lambda x: F.struct(
        x["key"].alias("path"), x["key"].alias("ord"), x["value"].alias("value"))), F.array().cast(_MEMBERS))
    # each level has an object that no earlier level had: the braces of the text bound the number of levels
    text = F.coalesce(F.to_json(payload), F.lit(""))
    levels = F.lit(depth) if depth else F.greatest(F.length(text) - F.length(F.replace(text, F.lit("{"), F.lit(""))), F.lit(1))

    def walk(acc: Column, _: Column) -> Column:
        below = F.flatten(F.transform(acc["last"], _children))
        return F.when(F.size(acc["last"]) == 0, acc).otherwise(
            F.struct(below.alias("last"), F.concat(acc["all"], below).alias("all")))
    start = F.struct(top.alias("last"), top.alias("all"))
    return F.aggregate(F.slice(F.sequence(F.lit(1), levels), F.lit(2), levels), start, walk, lambda acc: acc["all"])


def _paths(df: DataFrame, payload_col: str, keep: list[str], depth: int | None) -> DataFrame:
    """``keep`` and ``__p``: (path, order, type code) of every member, sorted; one row per input row."""
    names = F.array(*[F.lit(n) for n in TYPE_NAMES])
    typed = F.transform(F.transform("__m", lambda e: F.struct(
        e["path"].alias("path"), e["ord"].alias("ord"), e["value"].alias("value"),
        F.schema_of_variant(e["value"]).alias("s"))), lambda e: F.struct(
        e["path"].alias("path"), e["ord"].alias("ord"),
        F.array_position(names, type_name(e["value"], e["s"])).cast("int").alias("code")))
    return df.select(*keep, _members(F.col(payload_col), depth).alias("__m")).select(*keep, F.array_sort(typed).alias("__p"))


def event_paths(df: DataFrame, payload_col: str = "payload", keep: list[str] | None = None,
                depth: int | None = None) -> DataFrame:
    """DISC-1/2: one row per (event, path occurrence) with the type name
    (``field_type``). Non-object payloads (and NULL) yield nothing."""
    keep = list(keep if keep is not None else [c for c in df.columns if c != payload_col])
    names = F.array(*[F.lit(n) for n in TYPE_NAMES])
    rec = _paths(df.select(*keep, payload_col), payload_col, keep, depth)
    return rec.select(*keep, F.explode("__p").alias("__f")).select(
        *keep, F.col("__f.path").alias("path"), F.element_at(names, F.col("__f.code")).alias("field_type"))


# The type names of DISC-2, in code order for aggregation.
TYPE_NAMES = ("string", "integer", "long", "double", "boolean", "array", "object", "null", "unknown")
#: Place of a NULL ``seq`` in the order of events: after every 64-bit number.
LAST_SEQ = "10000000000000000000"


def discover(df: DataFrame, payload_col: str = "payload", seq_col: str = "seq",
             depth: int | None = None, group_cols: tuple[str, ...] = ()) -> DataFrame:
    """DISC-3 / AGG-11: (path, type, occurrences) over many payloads.

    Every row is one event, also when ``seq`` (a 64-bit number) repeats.
    ``occurrences`` counts events containing the path; ``type`` is the type in
    the event with the smallest ``seq`` (first seen wins; of equal ones the
    first of ``TYPE_NAMES``, NULL last). A path repeated in one event (a key
    containing ``.``) counts once and keeps the type met last in a depth-first
    walk of the keys in order. Repeats are settled inside the row, so the only
    shuffle is that of the partially aggregated (path, type) records.
    """
    keep = [*group_cols, seq_col]
    rec = _paths(df.select(*keep, payload_col), payload_col, keep, depth)
    last = F.filter("__p", lambda x, i: ~F.get(F.col("__p"), i + 1)["path"].eqNullSafe(x["path"]))
    rec = rec.select(*keep, F.explode(last).alias("__f"))
    # (seq, code) as one number: a fixed-width buffer keeps the aggregation hash-based
    seq = F.coalesce(F.col(seq_col).cast("decimal(34,0)"), F.lit(LAST_SEQ).cast("decimal(34,0)"))
    rec = rec.select(*group_cols, F.col("__f.path").alias("path"),
                     (seq * F.lit(16).cast("decimal(2,0)") + F.col("__f.code").cast("decimal(2,0)")).alias("__t"))
    out = rec.groupBy(*group_cols, "path").agg(F.min("__t").alias("__t"), F.count(F.lit(1)).alias("occurrences"))
    names = F.array(*[F.lit(n) for n in TYPE_NAMES])
    code = F.pmod(F.col("__t"), F.lit(16).cast("decimal(2,0)")).cast("int")
    return out.select(*group_cols, "path", F.element_at(names, code).alias("type"), "occurrences")


def field_sets(df: DataFrame, group_cols: list[str], payload_col: str = "payload",
               depth: int | None = None, count_col: str | None = None) -> DataFrame:
    """AGG-10: sorted set of field paths per group (names only).

    Names are first made distinct per group by a hash aggregation and then
    collected, so a group's state holds distinct names only. With
    ``count_col`` every input row also contributes a marker record, so the
    same single read yields the per-group row count (AGG-15) and
    groups whose payloads have no fields still appear (with ``[]``).
    """
    paths = F.transform(_members(F.col(payload_col), depth), lambda e: e["path"])
    if count_col:
        paths = F.concat(paths, F.array(F.lit(None).cast("string")))
    rec = df.select(*group_cols, F.explode(paths).alias("path"))
    names = rec.groupBy(*group_cols, "path").agg(F.count(F.lit(1)).alias("__n"))
    aggs = [F.array_sort(F.collect_list("path")).alias("field_names")]
    if count_col:
        aggs.append(F.sum(F.when(F.col("path").isNull(), F.col("__n"))).alias(count_col))
    return names.groupBy(*group_cols).agg(*aggs)
