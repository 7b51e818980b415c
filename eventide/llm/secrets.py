"""Secret scans: fixed patterns plus a Markov log-likelihood ratio, all in DataFrame expressions.

* Base spans: three fixed patterns, leftmost and non-overlapping per kind.
  Positions come from ``split`` and ``regexp_extract_all`` of the same pattern:
  the pieces between the matches and the matches alternate, so a match starts
  at the summed lengths before it (code points). Texts that a pattern does not
  touch cost one ``rlike`` pass of it.
* Method spans (kind ``random``): tokens of ``TOKEN`` characters are scored by
  two first-order character Markov models, one of random strings and one of
  ordinary identifiers; a token is kept when the summed log-likelihood ratio
  reaches ``MIN_LLR`` nats. Base spans are cut out first: of a token that
  touches one, each part left is scored as a token of its own.
* Training: a sample of ``SAMPLE_TEXTS`` distinct texts at most (the smallest
  text hashes, so it does not depend on row order); identifiers are its words
  outside base spans, long ones too unless they are ``MIXED``, names joined from
  them, dates and long decimal numbers (card, phone and record numbers are no
  secrets); random strings are its base values and encoded digests, letters of
  one case among them. The model is one table of ``len(ALPHABET)**2`` numbers,
  whatever the size of the input.

Null text is empty and has no spans; an empty table gives no rows; repeated
rows are scanned each on their own. Positions come from running sums in blocks,
so the work on a text grows little faster than the number of its spans (64,000
spans in 3 MB take seconds).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import apart

# The base patterns, in their listed order.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 8, 16, 32
KINDS = ["assign", "access", "hex", "random"]

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: A token to score: as many characters as the base patterns ask of a value. The ratio alone decides.
TOKEN = r"[A-Za-z0-9+/_=-]{8,}"
#: Tokens that may be secrets and are no training words: with a digit or a capital after a small letter.
MIXED = r"^(?=[A-Za-z+/_=-]*(?:[0-9]|[a-z][A-Z]))[A-Za-z0-9+/_=-]{8,}$"
MIN_LLR = 8.0
SAMPLE_TEXTS = 1000
#: Added to each pair count.
SMOOTHING = 0.5
MASK = "[SECRET]"
#: Values of a block of running sums, at least.
RUN = 64
#: Characters of a block in which positions are looked up.
BLOCK = 1024
#: Longer tokens are scored from an array of their characters.
LONG_TOKEN = 256

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _lit(pattern: str) -> Column:
    return F.lit(pattern)


def _kept(text: str, pattern: str, touch: str, kind: int, least: int, group: int = 0) -> Column:
    """Spans of a pattern whose ``group`` has ``least`` characters or more."""
    found = F.regexp_extract_all(F.col(text), _lit(pattern), F.lit(0))
    sized = F.regexp_extract_all(F.col(text), _lit(pattern), F.lit(group))
    between = F.split(F.col(text), pattern, -1)
    # zipped, so that the text is searched three times and not once for each match; the last piece has no match (null)
    matches = F.zip_with(found, sized, lambda m, g: F.struct(F.length(m).alias("n"), F.length(g).alias("g")))
    steps = F.zip_with(between, matches, lambda p, m: F.struct(
        F.length(p).alias("gap"), m["n"].alias("n"), (m["g"] >= least).alias("hit")))
    return F.when(F.col(text).rlike(touch), _placed(steps, kind)).otherwise(F.array().cast(_SPAN))


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once (as a variable of a lambda)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column, op) -> Column:
    """``op`` over all values before each one, from 0 (an array of whole numbers).

    In two levels, blocks of values and blocks of blocks: an array that grows
    is copied each time, so none is let grow beyond the root of their number.
    """
    def level(part: Column, all_: str, add) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast(all_).alias("out"))
        return F.aggregate(part, start, lambda a, x: F.struct(*[c.alias(n) for c, n in zip(add(a, x), ("at", "out"))]))

    def blocks(v: Column) -> Column:
        size = F.greatest(F.lit(RUN), F.ceil(F.sqrt(F.size(v))).cast("int"))
        return F.when(F.size(v) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / size).cast("int")), lambda b: level(
            F.slice(v, b * size + 1, size), "array<int>", lambda a, x: (op(a["at"], x), F.array_append(a["out"], a["at"])))))
    sums = level(_once(values, blocks), "array<array<int>>", lambda a, b: (
        op(a["at"], b["at"]), F.array_append(a["out"], F.transform(b["out"], lambda x: op(a["at"], x)))))
    return F.coalesce(F.flatten(sums["out"]), F.array().cast("array<int>"))


def _placed(steps: Column, kind: int) -> Column:
    """Spans of the steps (gap, n, hit) that are hits: a match starts where the gaps and matches before it end."""
    def spans(all_: Column) -> Column:
        ends = _running(F.transform(all_, lambda s: s["gap"] + F.coalesce(s["n"], F.lit(0))), lambda a, x: a + x)
        return F.transform(F.filter(F.arrays_zip(all_.alias("s"), ends.alias("at")), lambda x: x["s"]["hit"]), lambda x: F.struct(
            (x["at"] + x["s"]["gap"]).alias("start"), F.lit(kind).alias("kind"), (x["at"] + x["s"]["gap"] + x["s"]["n"]).alias("end")))
    return _once(steps, spans)


def _filled(text: str, spans: str, fill) -> Column:
    """The text with ``fill(span, greatest end before it)`` for its spans (ordered by start, they may overlap).

    Texts are cut at positions of blocks of ``BLOCK`` characters, as a position
    in a whole text is found by walking to it.
    """
    def piece(blocks: Column, a: Column, b: Column) -> Column:
        i, j = F.floor(a / BLOCK).cast("int"), F.floor(b / BLOCK).cast("int")
        first = F.get(blocks, i)
        return F.when(b <= a, "").when(i == j, F.substring(first, a % BLOCK + 1, b - a)).otherwise(F.concat(
            F.substring(first, a % BLOCK + 1, F.lit(BLOCK)), F.array_join(F.slice(blocks, i + 2, j - i - 1), ""),
            F.substring(F.coalesce(F.get(blocks, j), F.lit("")), F.lit(1), b % BLOCK)))

    def parts(blocks: Column) -> Column:
        ends = F.transform(F.col(spans), lambda s: s["end"])
        before = _running(ends, lambda a, x: F.greatest(a, x))
        cut = F.transform(F.arrays_zip(F.col(spans).alias("s"), before.alias("at")),
                          lambda x: F.concat(piece(blocks, x["at"], x["s"]["start"]), fill(x["s"], x["at"])))
        return F.array_join(F.concat(cut, F.array(piece(blocks, F.array_max(ends), F.length(text)))), "")
    blocks = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    return F.when(F.size(spans) > 0, _once(blocks, parts)).otherwise(F.col(text))


def base_spans(text: str = "__text") -> Column:
    """All base spans by start, then kind. The touch patterns only skip texts without any kept match."""
    return F.array_sort(F.concat(
        _kept(text, ASSIGN, r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", 0, ASSIGN_CHARS, 2),
        _kept(text, ACCESS, r"AKIA[A-Z0-9]{12}", 1, ACCESS_CHARS),
        _kept(text, r"[0-9a-f]{32,}", r"[0-9a-f]{32}", 2, HEX_CHARS)))


def _pair_code(token: Column, i: Column) -> Column:
    """Position of the pair at i (from 1) in the table, null outside the alphabet."""
    a = F.instr(F.lit(ALPHABET), token.substr(i, F.lit(1)))
    b = F.instr(F.lit(ALPHABET), token.substr(i + 1, F.lit(1)))
    return (a - 1) * len(ALPHABET) + b - 1


def train(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE_TEXTS) -> np.ndarray:
    """Log-likelihood ratios (random over identifier) of all character pairs."""
    texts = docs.select(F.col(text_col).alias("__text")).where("__text is not null")
    picked = texts.select(F.xxhash64("__text").alias("h")).distinct().orderBy("h").limit(sample)
    sampled = (texts.withColumn("h", F.xxhash64("__text")).join(F.broadcast(picked), "h", "left_semi")
               .dropDuplicates(["h"]))
    spans = sampled.withColumn("__spans", base_spans()).withColumn("digest", F.sha2("__text", 512))
    values = F.transform("__spans", lambda s: F.substring(F.col("__text"), s["start"] + 1, s["end"] - s["start"]))
    values = F.transform(values, lambda v: F.regexp_extract(v, r"([A-Za-z0-9+/_.=-]+)$", 1))
    encoded = F.base64(F.unhex("digest"))
    random = F.concat(values, F.array(F.col("digest"), encoded, F.translate(encoded, "+/", "-_"),
                                      F.upper(F.translate(encoded, "+/=", "")), F.translate(encoded, "+/=", ""),
                                      F.lower(F.translate(encoded, "0123456789+/=", "")),
                                      F.upper(F.translate(encoded, "0123456789+/=", ""))))
    clear = F.aggregate("__spans", F.col("__text"), lambda t, s: F.replace(
        t, F.substring(F.col("__text"), s["start"] + 1, s["end"] - s["start"]), F.lit(" ")))
    words = F.filter(F.split(clear, r"[^A-Za-z0-9+/_=-]+"), lambda w: (F.length(w) >= 3) & ~w.rlike(MIXED))
    spans = spans.withColumn("words", words)
    after = F.transform("words", lambda w, i: F.coalesce(F.get("words", i + 1), w))
    spans = spans.withColumn("names", F.zip_with("words", after, lambda a, b: F.concat(
        F.lower(a), F.lit("_"), F.lower(b), F.initcap(F.lower(a)), F.lit("-"), F.lower(b), F.lit("/"), F.lower(a),
        F.lit("/"), F.upper(b), F.lit("_"), F.upper(a))))
    year = F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), F.pmod(F.col("h"), F.lit(20000)).cast("int")),
                         "yyyy-MM-dd")
    number = F.pmod(F.col("h"), F.lit(10 ** 16)).cast("string")
    numbers = F.array(F.lpad(number, 16, "0"), F.reverse(F.lpad(number, 19, "0")))
    plain = F.concat(F.col("words"), F.col("names"), numbers,
                     F.array(F.concat(year, F.lit("_"), year), F.concat(year, F.lit("/00001/00002000"))))
    tokens = spans.select(F.explode(F.concat(
        F.transform(random, lambda t: F.struct(F.lit(1).alias("label"), t.alias("token"))),
        F.transform(plain, lambda t: F.struct(F.lit(0).alias("label"), t.alias("token"))))).alias("t")).select("t.*")
    pairs = (tokens.where(F.length("token") > 1)
             .select("label", F.explode(F.transform(F.sequence(F.lit(1), F.length("token") - 1),
                                                    lambda i: _pair_code(F.col("token"), i))).alias("pair"))
             .where("pair >= 0").groupBy("label", "pair").count())
    n = len(ALPHABET)
    counts = np.full((2, n * n), SMOOTHING)
    for r in pairs.collect():  # 2 * len(ALPHABET)**2 rows at most
        counts[r["label"], r["pair"]] += r["count"]
    given = counts.reshape(2, n, n)
    logs = np.log(given / given.sum(axis=2, keepdims=True))
    return (logs[1] - logs[0]).reshape(-1)


def _without(text: str, spans: str, fill: str) -> Column:
    """The text with ``fill`` for each character of the spans, which are ordered by start and may overlap."""
    return _filled(text, spans, lambda s, at: F.repeat(F.lit(fill), s["end"] - F.greatest(at, s["start"])))


def random_spans(model: np.ndarray, text: str = "__rest", min_llr: float = MIN_LLR) -> Column:
    """Token spans that the models call random. ``text`` holds spaces for its base spans."""
    table = F.lit(model)
    tokens = F.regexp_extract_all(F.col(text), _lit(TOKEN), F.lit(0))
    between = F.split(F.col(text), TOKEN, -1)

    def score(t: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.length(t) - 1), F.lit(0.0),
                           lambda a, i: a + F.get(table, _pair_code(t, i)))

    def score_long(t: Column) -> Column:
        """The same sum over an array of the characters: a position in a long token is found by walking to it."""
        codes = F.transform(F.regexp_extract_all(t, F.lit("."), F.lit(0)), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
        start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))
        return F.aggregate(codes, start, lambda a, c: F.struct(c.alias("last"), F.when(a["last"] < 0, a["sum"]).otherwise(
            a["sum"] + F.get(table, a["last"] * len(ALPHABET) + c)).alias("sum")), lambda a: a["sum"])
    # zipped, so that the text is split once and not for each token; the piece after the last token has none (null)
    steps = F.zip_with(between, tokens, lambda g, t: F.struct(
        F.length(g).alias("gap"), F.length(t).alias("n"), (F.when(F.length(t) <= LONG_TOKEN, score(t)).otherwise(score_long(t)) >= min_llr).alias("hit")))
    return F.when(F.col(text).rlike(TOKEN), _placed(steps, 3)).otherwise(F.array().cast(_SPAN))


def scan(docs: DataFrame, text_col: str = "text", model: np.ndarray | None = None) -> DataFrame:
    """``docs`` with ``__text`` (never null), ``__base``, ``__rest`` (the text without base spans) and ``__spans``
    (all spans by start, then kind)."""
    model = train(docs, text_col) if model is None else model
    found = docs.withColumn("__text", F.coalesce(F.col(text_col), F.lit(""))).withColumn("__base", base_spans())
    found = found.withColumn("__rest", _without("__text", "__base", " "))
    return found.withColumn("__spans", F.array_sort(F.concat("__base", random_spans(model))))


def span_text(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(docs: DataFrame, text_col: str = "text", n_chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with each span (overlapping ones as one) replaced by a mask; other rows keep their text, and all other columns
    are as they were, whatever their names."""
    plain, back = apart(docs, {"__text", "__base", "__rest", "__spans", "__new"})
    found = scan(plain, text_col)
    masked = _filled("__text", "__spans", lambda s, at: F.when(s["start"] >= at, MASK).otherwise(""))
    hit = F.size("__spans") > 0
    out = found.withColumn("__new", F.when(hit, masked).otherwise(F.col(text_col)))
    out = out.withColumn(text_col, F.col("__new"))
    if n_chars_col in docs.columns:
        out = out.withColumn(n_chars_col, F.when(hit, F.length("__new").cast("long")).otherwise(F.col(n_chars_col)))
    return out.select(*back)
