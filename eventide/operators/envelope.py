"""ENV-1..5 and VAL-1..3: envelope build/parse/serialise and request checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.json import as_text, kind
from eventide.functions.sqltext import ident, lit
from eventide.model import ENVELOPE_KEYS, ID_PREFIX, MAX_BATCH, STATUS_VALUES

ISO_WITH_OFFSET = (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?"
                   r"(Z|[+-][0-9]{2}:[0-9]{2}(:[0-9]{2})?)$")


def new_id() -> Column:
    return F.concat(F.lit(ID_PREFIX), F.expr("uuid()"))


_FIELDS = {"id": "id", "type": "type", "source": "source", "timestamp": "ts", "payload": "payload",
           "metadata": "metadata", "status": "status", "errorMessage": "err", "processedAt": "pat"}
_SCALARS = ("id", "type", "source", "ts", "status", "err", "pat")
_TIMES = ("ts", "pat")


# Times outside years 1 to 9999 are unreadable.
MIN_MICROS, MAX_MICROS = -62135596800000000, 253402300799999999


def _kind_sql(sc: str) -> str:
    return (f"CASE WHEN {sc} IS NULL THEN NULL WHEN startswith({sc}, 'OBJECT') THEN 'object' "
            f"WHEN startswith({sc}, 'ARRAY') THEN 'array' WHEN {sc} = 'STRING' THEN 'string' "
            f"WHEN {sc} = 'BOOLEAN' THEN 'boolean' WHEN {sc} = 'VOID' THEN 'null' ELSE 'number' END")


def _text_sql(n: str) -> str:
    """Scalar -> text, JSON null -> NULL; objects/arrays are a parse error."""
    r, k = f"`__r_{n}`", f"`__k_{n}`"
    return (f"CASE WHEN {r} IS NULL OR {k} = 'null' THEN CAST(NULL AS STRING) "
            f"WHEN {k} IN ('object', 'array') THEN '' ELSE CAST({r} AS STRING) END")


def _text_bad(n: str) -> str:
    return f"(`__r_{n}` IS NOT NULL AND `__k_{n}` IN ('object', 'array'))"


def _micros_sql(n: str) -> str:
    """Epoch microseconds of a number."""
    r, k = f"`__r_{n}`", f"`__k_{n}`"
    return (f"CASE WHEN {k} = 'number' THEN "
            f"try_cast(try_multiply(try_variant_get({r}, '$', 'decimal(38,9)'), 1000000BD) AS BIGINT) END")


def _time_sql(n: str) -> str:
    """Epoch seconds (number) or ISO offset text -> timestamp."""
    k, t, micros = f"`__k_{n}`", f"`__t_{n}`", f"`__u_{n}`"
    return (f"CASE WHEN {k} = 'number' THEN CASE WHEN {micros} BETWEEN {MIN_MICROS} AND {MAX_MICROS} "
            f"THEN timestamp_micros({micros}) END "
            f"WHEN {k} = 'string' THEN CASE WHEN {t} RLIKE {lit(ISO_WITH_OFFSET)} THEN try_to_timestamp({t}) END END")


def _time_bad(n: str) -> str:
    return f"(`__r_{n}` IS NOT NULL AND `__k_{n}` <> 'null' AND `__v_{n}` IS NULL)"


def parse_envelopes(df: DataFrame, value_col: str = "value") -> DataFrame:
    """ENV-2 + ENV-4: parse envelope JSON text once; ``parse_ok`` marks success.

    A record fails when it is not a JSON object, has a key outside the nine
    envelope names, has an object/array where text is expected, an unknown
    status, or an unreadable time. Absent id/timestamp/status get defaults;
    a JSON null stays NULL. ``raw`` keeps the text for the dead letter (RT-3).
    The text is parsed once; members, their kinds, texts and times are projected
    as columns. Members are looked up in the record's map: a ``try_variant_get``
    of an absent key costs many times one that finds it.
    """
    st = df.selectExpr("*", f"try_variant_get(try_parse_json({ident(value_col)}), '$', 'map<string,variant>') AS `__pm`")
    allowed = ", ".join(lit(k) for k in ENVELOPE_KEYS)
    st = st.selectExpr("*", f"(`__pm` IS NOT NULL AND size(array_except(map_keys(`__pm`), array({allowed}))) = 0) AS `__shaped`",
                       *[f"try_element_at(`__pm`, {lit(k)}) AS `__r_{n}`" for k, n in _FIELDS.items()])
    st = st.selectExpr("*", *[f"CASE WHEN `__r_{n}` IS NOT NULL THEN schema_of_variant(`__r_{n}`) END AS `__sc_{n}`"
                              for n in _SCALARS])
    st = st.selectExpr("*", *[f"{_kind_sql(f'`__sc_{n}`')} AS `__k_{n}`" for n in _SCALARS])
    st = st.selectExpr("*", *[f"{_text_sql(n)} AS `__t_{n}`" for n in _SCALARS if n not in _TIMES],
                       *[f"CASE WHEN `__k_{n}` = 'string' THEN CAST(`__r_{n}` AS STRING) END AS `__t_{n}`" for n in _TIMES],
                       *[f"{_micros_sql(n)} AS `__u_{n}`" for n in _TIMES])
    statuses = ", ".join(lit(x) for x in STATUS_VALUES)
    status = (f"CASE WHEN `__k_status` = 'number' THEN get(array({statuses}), "
              f"try_variant_get(`__r_status`, '$', 'int')) ELSE `__t_status` END")
    st = st.selectExpr("*", *[f"{_time_sql(n)} AS `__v_{n}`" for n in _TIMES], f"{status} AS `__v_status`")
    status_ok = f"(`__r_status` IS NULL OR `__k_status` = 'null' OR coalesce(`__v_status` IN ({statuses}), false))"
    bad = " OR ".join([*[_text_bad(n) for n in ("id", "type", "source", "err", "status")], *[_time_bad(n) for n in _TIMES]])
    ok = f"coalesce(`__shaped` AND NOT ({bad}) AND {status_ok}, false)"
    # (exploded, so that a filter on parse_ok is not pushed below the parse and does not repeat it member by member)
    st = st.selectExpr("*", f"explode(array({ok})) AS `__ok`")
    new = {
        "parse_ok": "`__ok`",
        "id": f"CASE WHEN `__r_id` IS NULL THEN concat({lit(ID_PREFIX)}, uuid()) ELSE `__t_id` END",
        "type": "`__t_type`", "source": "`__t_source`",
        "timestamp": "CASE WHEN `__r_ts` IS NULL THEN current_timestamp() ELSE `__v_ts` END",
        "payload": "`__r_payload`", "metadata": "`__r_metadata`",
        "status": "CASE WHEN `__r_status` IS NULL THEN 'RECEIVED' ELSE `__v_status` END",
        "error_message": "`__t_err`", "processed_at": "`__v_pat`", "raw": ident(value_col),
    }
    keep = [ident(c) for c in st.columns if c not in new and not (c.startswith("__") and c not in df.columns)]
    return st.selectExpr(*keep, *[f"{v} AS {ident(k)}" for k, v in new.items()])


def _epoch(ts: Column) -> Column:
    return (F.unix_micros(ts).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(20,6)")


def envelope_json(payload: Column, status: Column, error_message: Column, processed_at: Column) -> Column:
    """ENV-3: JSON text of an envelope whose outcome is given; the other members are columns."""
    return F.to_json(F.struct(
        F.col("id").alias("id"), F.col("type").alias("type"), F.col("source").alias("source"),
        _epoch(F.col("timestamp")).alias("timestamp"), payload.alias("payload"),
        F.col("metadata").alias("metadata"), status.alias("status"),
        error_message.alias("errorMessage"), _epoch(processed_at).alias("processedAt")))


def serialize(df: DataFrame, out_col: str = "value") -> DataFrame:
    """ENV-3: envelope -> JSON text, NULL fields omitted, times as epoch seconds."""
    return df.withColumn(out_col, envelope_json(F.col("payload"), F.col("status"), F.col("error_message"),
                                                F.col("processed_at")))


def build_envelopes(requests: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """ENV-1: accepted requests -> new envelopes (id, now, RECEIVED)."""
    return requests.select(*keep,
        new_id().alias("id"), F.col("type"), F.col("source"),
        F.current_timestamp().alias("timestamp"), F.col("payload"), F.col("metadata"),
        F.lit("RECEIVED").alias("status"), F.lit(None).cast("string").alias("error_message"),
        F.lit(None).cast("timestamp").alias("processed_at"))


def to_table_rows(envelopes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """ENV-5: envelope -> ``stored_events`` row (plus ``keep`` columns)."""
    return envelopes.select(*keep,
        "id", "type", "source",
        F.to_json(F.col("payload")).alias("payload"),
        F.when(F.col("metadata").isNotNull(), F.to_json(F.col("metadata"))).alias("metadata"),
        F.coalesce(F.col("status"), F.lit("UNKNOWN")).alias("status"),
        "error_message",
        F.col("timestamp").alias("received_at"),
        "processed_at",
        F.current_timestamp().alias("stored_at"))


def _blank(c: Column) -> Column:
    return c.isNull() | ~c.rlike(r"[^\x00-\x20]")


def parse_requests(df: DataFrame, value_col: str = "value") -> DataFrame:
    """VAL-3 + VAL-1: parse request bodies, list violated fields, flag validity.

    A body is malformed when it is not a JSON object or holds an object or
    array where text belongs; a malformed body has no violations.
    """
    v = F.try_parse_json(F.col(value_col))
    t_raw, s_raw, p_raw = (F.try_variant_get(v, f"$['{k}']", "variant") for k in ("type", "source", "payload"))
    t = F.when(kind(t_raw) != "null", as_text(t_raw))
    s = F.when(kind(s_raw) != "null", as_text(s_raw))
    violations = F.array_compact(F.array(
        F.when(_blank(t), F.lit("type")), F.when(_blank(s), F.lit("source")),
        # only an absent payload violates: a JSON null is a (null) JSON node
        F.when(p_raw.isNull(), F.lit("payload"))))
    nested = [F.coalesce(kind(r).isin("object", "array"), F.lit(False)) for r in (t_raw, s_raw)]
    malformed = v.isNull() | (kind(v) != "object") | nested[0] | nested[1]
    return df.withColumns({
        "type": t, "source": s, "payload": p_raw,
        "metadata": F.try_variant_get(v, "$['metadata']", "variant"),
        "malformed": malformed,
        "violations": F.when(malformed, F.array().cast("array<string>")).otherwise(violations),
        "valid": ~malformed & (F.size(violations) == 0),
    })


def check_batch_size(df: DataFrame, batch_col: str = "batch_id", max_batch: int = MAX_BATCH) -> DataFrame:
    """VAL-2: reject whole batches above ``max_batch`` rows.

    Batch sizes come from a partially aggregated ``groupBy`` joined back on the
    batch key (AQE broadcasts the per-batch counts when they are small), so a
    huge batch never lands in one window partition.
    """
    sizes = df.groupBy(batch_col).agg(F.count(F.lit(1)).alias("batch_size"))
    out = df.join(sizes, batch_col, "left")
    return out.withColumns({
        "batch_rejected": F.col("batch_size") > max_batch,
        "batch_error": F.when(F.col("batch_size") > max_batch, F.format_string(
            "Batch size %d exceeds maximum of %d", F.col("batch_size"), F.lit(max_batch))),
    })


def check_batch_requests(parsed: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """VAL-1/3 for batches: one invalid or malformed request rejects its whole batch.

    Input: the output of ``parse_requests``. Counts are partially aggregated
    per batch and joined back, as in ``check_batch_size``.
    """
    bad = parsed.groupBy(batch_col).agg(F.count_if(~F.col("valid")).alias("invalid_requests"))
    return parsed.join(bad, batch_col, "left").withColumn("batch_invalid", F.col("invalid_requests") > 0)
