"""MAP-1..12: compile an ordered mapping list into one projection.

The mapping list is turned, on the driver and once per definition, into
Catalyst expressions over the ``payload`` VARIANT column:

* per mapping *i*: ``src_i`` (path lookup), ``applied_i`` (present, or a
  default exists), ``out_i`` / ``err_i`` (conversion of the value);
* **static tree** (the common case: no FLATTEN, no destination that is a
  prefix of another): every destination leaf is ``coalesce`` of its writers
  in reverse order (later present writes win), every object node is a
  ``to_variant_object(map_filter(map(...)))`` guarded by "any descendant
  written", so absent branches vanish and an empty root prints ``{}``;
* **ordered tree** (FLATTEN of objects, value/object conflicts on a path):
  the output VARIANT is rebuilt mapping by mapping with ``map_concat``
  (LAST_WIN) over one projection per mapping, which is the exact
  write-in-order semantics without expression blow-up.

``map_error`` is the first error in mapping order, so whole-event failure
(RT-2) reports the same mapping the reference would stop at.
No Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.conversions import NOW_ISO_SQL, Val, as_column, conversion, needs_text, number_parts, scalar_text
from eventide.functions.json import as_read, jtrim, split_path
from eventide.functions.sqltext import ident, lit
from eventide.model import NOW_TOKEN, UUID_TOKEN, FieldMapping, Flow

EMPTY_DEST_ERROR = "Index -1 out of bounds for length 0"


def _default_sql(default: str) -> str:
    if default == NOW_TOKEN:
        return f"CAST({NOW_ISO_SQL} AS VARIANT)"
    if default == UUID_TOKEN:
        return "CAST(uuid() AS VARIANT)"
    return f"CAST({lit(default)} AS VARIANT)"


class _Step:
    """One compiled mapping; its parts are materialised as ``__*{idx}`` columns.

    Stage expressions are SQL text over those column names (one JVM parse
    per stage instead of many Python ``Column`` calls).
    """

    def __init__(self, idx: int, mp: FieldMapping):
        self.idx = idx
        self.mapping = mp
        self.src_parts = split_path(mp.source_field)
        self.dest = split_path(mp.destination_field)
        self.flatten = mp.conversion == "FLATTEN"
        self.text = needs_text(mp.conversion)
        self.schema = self.text or self.flatten or mp.conversion in (None, "NONE")
        i = idx
        self.n = {k: f"__{k}{i}" for k in ("s", "a", "v", "sc", "k", "t", "tt", "l", "w", "d", "o", "e")}
        self.q = {k: ident(v) for k, v in self.n.items()}
        self.s, self.applied, self.value = (F.col(self.n[k]) for k in ("s", "a", "v"))
        self.kind, self.out, self.err_col = F.col(self.n["k"]), F.col(self.n["o"]), F.col(self.n["e"])
        self.numbers = number_parts(mp.conversion, self.q["v"], self.q["k"], self.q["sc"])
        self.has_err = False

    def stage_source(self, payload: str, objects: dict) -> dict:
        if self.src_parts is None:
            return {self.n["s"]: "CAST(NULL AS VARIANT)"}
        if not self.src_parts:
            return {self.n["s"]: payload}
        return {self.n["s"]: f"try_element_at({objects[tuple(self.src_parts[:-1])]}, {lit(self.src_parts[-1])})"}

    def stage_value(self) -> dict:
        s = self.q["s"]
        has = f"({s} IS NOT NULL AND NOT is_variant_null({s}))"
        mp = self.mapping
        if mp.default_value is not None:
            return {self.n["a"]: "true", self.n["v"]: f"CASE WHEN {has} THEN {s} ELSE {_default_sql(mp.default_value)} END"}
        return {self.n["a"]: has, self.n["v"]: f"CASE WHEN {has} THEN {s} END"}

    def stage_schema(self) -> dict:
        return {self.n["sc"]: f"schema_of_variant({self.q['v']})"} if self.schema else {}

    def stage_kind(self) -> dict:
        if not (self.text or self.flatten):
            return {}
        sc = self.q["sc"]
        return {self.n["k"]: (f"CASE WHEN startswith({sc}, 'OBJECT') THEN 'object' WHEN startswith({sc}, 'ARRAY') "
                              f"THEN 'array' WHEN {sc} = 'STRING' THEN 'string' WHEN {sc} = 'BOOLEAN' THEN 'boolean' "
                              f"WHEN {sc} = 'VOID' THEN 'null' ELSE 'number' END")}

    def stage_text(self) -> dict:
        if not self.text:
            return {}
        v, k = self.q["v"], self.q["k"]
        if self.numbers:  # numbers come in parts
            return {self.n["t"]: f"CASE WHEN {k} = 'number' THEN CAST(NULL AS STRING) WHEN {k} IN ('object', 'array') THEN '' "
                                 f"ELSE CAST({v} AS STRING) END"}
        return {self.n["t"]: scalar_text(v, k, self.q["sc"])}

    def stage_trim(self) -> dict:
        return {self.n["tt"]: jtrim(F.col(self.n["t"]))} if self.text else {}

    def stage_number(self) -> dict:
        return {self.n[p]: e for p, e in self.numbers.items()}

    def stage_convert(self) -> dict:
        q = self.q
        out, err = conversion(self.mapping.conversion)(
            Val(q["v"], q["k"], q["t"], q["tt"], q["sc"], *[q[p] if p in self.numbers else None for p in ("l", "w", "d")]))
        if self.dest is not None and len(self.dest) == 0:
            # "." as destination: the reference fails the event when it writes there
            bad = lit(EMPTY_DEST_ERROR)
            if self.flatten:
                bad = f"CASE WHEN {q['k']} <> 'object' THEN {bad} END"
            err = bad if err is None else F.coalesce(as_column(err), F.expr(bad))
        cols = {self.n["o"]: out}
        if err is not None:
            self.has_err = True
            e = as_column(err)
            cols[self.n["e"]] = F.when(F.col(self.n["a"]), e)
        return cols


def _apply_stage(df: DataFrame, cols: dict) -> DataFrame:
    """Add columns given as SQL text (one ``selectExpr``) or ``Column``s."""
    text = {k: v for k, v in cols.items() if isinstance(v, str)}
    other = {k: v for k, v in cols.items() if not isinstance(v, str)}
    if text:
        df = df.selectExpr("*", *[f"{v} AS {ident(k)}" for k, v in text.items()])
    if other:
        df = df.withColumns(other)
    return df


def _source_objects(df: DataFrame, steps: list[_Step], payload: str) -> tuple[DataFrame, dict]:
    """The payload and the objects on the way to a source field as maps, one column each: path -> column.

    A ``try_variant_get`` of an absent key costs many times one that finds it, a lookup in a map does not.
    """
    paths = {tuple(s.src_parts[:k]) for s in steps for k in range(len(s.src_parts or ()))}
    objects = {p: f"__m{i}" for i, p in enumerate(sorted(paths, key=lambda p: (len(p), p)))}
    for depth in range(max(map(len, objects), default=-1) + 1):
        df = _apply_stage(df, {n: (f"try_variant_get({f'try_element_at({ident(objects[p[:-1]])}, {lit(p[-1])})' if p else payload}, "
                                   f"'$', '{_EMPTY}')") for p, n in objects.items() if len(p) == depth})
    return df, {p: ident(n) for p, n in objects.items()}


def _needs_ordered(steps: list[_Step]) -> bool:
    dests = [tuple(s.dest) for s in steps if s.dest]
    if any(s.flatten for s in steps):
        return True
    ds = set(dests)
    for d in ds:
        for k in range(1, len(d)):
            if d[:k] in ds:
                return True
    return False


def _static_tree(steps: list[_Step]) -> str:
    tree: dict = {}
    for s in steps:
        if not s.dest:
            continue
        node = tree
        for p in s.dest[:-1]:
            node = node.setdefault(p, {})
        node.setdefault(s.dest[-1], []).append(s)

    def either(flags: list[str]) -> str:
        return flags[0] if len(flags) == 1 else "(" + " OR ".join(flags) + ")"

    def build(node: dict) -> tuple[str, str]:
        kvs, flags = [], []
        for key, child in node.items():
            if isinstance(child, list):
                # (a column used twice is projected below: map_filter would interpret what is written into it)
                parts = [f"CASE WHEN {s.q['a']} AND {s.q['o']} IS NOT NULL THEN {s.q['o']} END" for s in reversed(child)]
                val = parts[0] if len(parts) == 1 else f"coalesce({', '.join(parts)})"
                flag = either([s.q["a"] for s in child])
            else:
                obj, flag = build(child)
                val = f"CASE WHEN {flag} THEN {obj} END"
            kvs += [lit(key), val]
            flags.append(flag)
        if not kvs:
            return "parse_json('{}')", "false"
        return (f"to_variant_object(map_filter(map({', '.join(kvs)}), (k, v) -> v IS NOT NULL))",
                either(flags))

    root, _ = build(tree)
    return root


_EMPTY = "map<string,variant>"


def _obj_map(v: Column) -> Column:
    """Members of an object as map<string,variant>; empty for anything else."""
    return F.coalesce(F.try_variant_get(v, "$", _EMPTY), F.create_map().cast(_EMPTY))


def _set_path(m: Column, parts: list[str], val: Column) -> Column:
    """setField on an object held as a map: create/replace objects along the
    path (a non-object in the way becomes a new object), then set the leaf."""
    head, rest = parts[0], parts[1:]
    if rest:
        val = F.to_variant_object(_set_path(_obj_map(m[head]), rest, val))
    return F.map_concat(m, F.create_map(F.lit(head), val))


def _flatten_into(m: Column, parts: list[str], obj: Column) -> Column:
    """FLATTEN of an object: copy its members under ``parts``.

    At the root (no ``parts``) a member's key stays a key; below a prefix a
    ``.`` in it nests, as in any destination path (MAP-9).
    """
    members = F.transform_values(_obj_map(obj), lambda _, v: as_read(v))
    if not parts:
        return F.map_concat(m, members)
    head, rest = parts[0], parts[1:]
    inner = _obj_map(m[head])
    merged = _flatten_into(inner, rest, obj) if rest else _nest_members(inner, members)
    return F.map_concat(m, F.create_map(F.lit(head), F.to_variant_object(merged)))


def _nest_members(m: Column, members: Column) -> Column:
    """Members added to ``m``, their dotted keys as paths (trailing dots dropped), of any depth.

    Only objects that hold a dotted key take the second way: all entries are
    (path, value) pairs, and from the deepest level up the pairs of one parent
    become that parent's object, merged over the object it already is.
    """
    dotted = F.exists(F.map_keys(members), lambda k: F.contains(k, F.lit(".")))
    own = F.transform(F.map_entries(m), lambda e: F.struct(F.array(e["key"]).alias("p"), e["value"].alias("v")))
    new = F.transform(F.map_entries(members), lambda e: F.struct(
        F.split(F.rtrim(e["key"], F.lit(".")), r"\.").alias("p"), e["value"].alias("v")))
    pairs = F.concat(own, new)

    def lift(acc: Column, level: Column) -> Column:
        deep = F.filter(acc, lambda e: F.size(e["p"]) == level)
        rest = F.filter(acc, lambda e: F.size(e["p"]) < level)
        parents = F.array_distinct(F.transform(deep, lambda e: F.slice(e["p"], F.lit(1), level - 1)))
        built = F.transform(parents, lambda q: F.struct(q.alias("p"), F.to_variant_object(F.map_concat(
            _obj_map(F.try_element_at(F.filter(rest, lambda e: e["p"] == q), F.lit(-1))["v"]),
            F.map_from_entries(F.transform(
                F.filter(deep, lambda e: F.slice(e["p"], F.lit(1), level - 1) == q),
                lambda e: F.struct(F.element_at(e["p"], -1), e["v"]))))).alias("v")))
        return F.concat(rest, built)

    deepest = F.greatest(F.array_max(F.transform(pairs, lambda e: F.size(e["p"]))), F.lit(2))
    nested = F.aggregate(F.sequence(deepest, F.lit(2), F.lit(-1)), pairs, lift)
    nested = F.map_from_entries(F.transform(nested, lambda e: F.struct(F.get(e["p"], F.lit(0)), e["v"])))
    return F.when(dotted, nested).otherwise(F.map_concat(m, members))


def compile_mappings(df: DataFrame, mappings: Sequence[FieldMapping], payload_col: str = "payload",
                     out_col: str = "mapped", err_col: str = "map_error") -> DataFrame:
    """MAP-1: add ``mapped`` (VARIANT object) and ``map_error`` (first error text).

    Each step's lookup, value, kind and text are projected once as columns
    (Catalyst does not re-inline non-trivial expressions used more than
    once), which keeps the generated code small and each value parsed once.
    """
    payload = ident(payload_col)
    steps = [_Step(i, mp) for i, mp in enumerate(mappings) if not mp.excluded]  # MAP-3
    cur, objects = _source_objects(df, steps, payload)
    for stage in ("stage_source", "stage_value", "stage_schema", "stage_kind", "stage_text", "stage_trim",
                  "stage_number", "stage_convert"):
        cols = {}
        for s in steps:
            cols.update(s.stage_source(payload, objects) if stage == "stage_source" else getattr(s, stage)())
        if cols:
            cur = _apply_stage(cur, cols)
    errs = [s.err_col for s in steps if s.has_err]
    err = F.coalesce(*errs) if len(errs) > 1 else (errs[0] if errs else F.lit(None).cast("string"))
    temps = [c for c in cur.columns if c.startswith("__") and c not in df.columns]
    if not _needs_ordered(steps):
        return cur.withColumns({out_col: F.expr(_static_tree(steps)), err_col: err}).drop(*temps)

    # Ordered tree: fold the writes in mapping order, one projection per write;
    # the root object is carried as a map<string,variant> and turned into a
    # VARIANT object once at the end.
    cur = cur.withColumns({err_col: err, out_col: F.create_map().cast(_EMPTY)})
    for s in steps:
        a = s.applied
        v = s.out
        o = F.col(out_col)
        if s.dest is None or len(s.dest) == 0:
            if not s.flatten or s.dest is not None:
                continue  # no write (or the error path)
            nxt = F.when(a & (s.kind == "object"), _flatten_into(o, [], v)).otherwise(o)
        elif s.flatten:
            nxt = (F.when(a & (s.kind == "object"), _flatten_into(o, s.dest, v))
                   .when(a, _set_path(o, s.dest, v)).otherwise(o))
        else:
            nxt = F.when(a, _set_path(o, s.dest, v)).otherwise(o)
        cur = cur.withColumn(out_col, nxt)
    return cur.withColumn(out_col, F.to_variant_object(F.col(out_col))).drop(*temps)


def apply_flow(envelopes: DataFrame, flow: Flow) -> DataFrame:
    """MAP-12 + RT-2: map every parsed envelope, tag PROCESSED or FAILED.

    Input: the output of ``parse_envelopes`` (``parse_ok`` + envelope columns).
    Success: payload replaced, status PROCESSED, processed_at now.
    Failure: original payload kept, status FAILED, ``[name] message``.
    Unparseable rows keep ``parse_ok = false`` and go to the dead letter verbatim.
    """
    mapped = compile_mappings(envelopes, flow.mappings)
    ok = F.col("parse_ok") & F.col("map_error").isNull()
    failed = F.col("parse_ok") & F.col("map_error").isNotNull()
    return mapped.withColumns({
        "payload": F.when(ok, F.col("mapped")).otherwise(F.col("payload")),
        "status": F.when(ok, F.lit("PROCESSED")).when(failed, F.lit("FAILED")).otherwise(F.col("status")),
        "error_message": F.when(failed, F.concat(F.lit(f"[{flow.name}] "), F.col("map_error")))
        .otherwise(F.col("error_message")),
        "processed_at": F.when(F.col("parse_ok"), F.current_timestamp()).otherwise(F.col("processed_at")),
        "flow": F.lit(flow.name),
    }).drop("mapped", "map_error")


def preview(payloads: DataFrame, mappings: Sequence[FieldMapping], payload_col: str = "payload") -> DataFrame:
    """MAP-11: run a mapping list over sample payloads without publishing."""
    return compile_mappings(payloads, mappings, payload_col=payload_col)
