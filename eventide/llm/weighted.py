"""Consistent weighted sampling fingerprints, all in DataFrame expressions.

A text is a bag of lower-cased words weighted by their counts. For each of
``SLOTS`` hash functions and each word, seeded uniforms give r, c ~ Gamma(2, 1)
and b ~ U(0, 1); with weight w, t = floor(ln w / r + b) and
ln a = ln c - r (t - b + 1). The slot keeps the smallest ln a of the text. Two
texts agree on a slot with a probability equal to their generalised Jaccard
similarity sum(min w) / sum(max w). ln a is a function of (word, t) alone and
differs between different ones, so the minimum itself is the signature.

Words and their counts are found inside the row (hash, sort, run lengths); the
exploded (word, weight) rows never leave their task: the minima are combined
map-side into one row per text before the only shuffle of the aggregation.

The neighbour of a document is the next one by (doc_id, text hash), the first
after the last. It is found over ids range-partitioned by that key (a lead per
partition and one row per partition for the seams); only the needed head of
its text is shuffled besides the texts themselves.

Null text is empty; texts without words share the empty fingerprint (every
slot zero). A null doc_id sorts first. Rows repeating doc_id and text are one
document, given back as often as they occur. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import checkpoint, shuffle_partitions

SLOTS = 32
#: Stands for a null doc_id in sort and join keys.
NO_ID = -(1 << 63)


def words(body: str) -> Column:
    """Sorted word hashes of a text."""
    found = F.filter(F.split(F.lower(F.col(body)), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.sort_array(F.transform(found, lambda w: F.xxhash64(w)))


def _uniform(bits: Column) -> Column:
    """32 bits to the open interval (0, 1)."""
    return (bits + F.lit(0.5)) / F.lit(4294967296.0)


def sample(term: str, log_weight: str, slot: int) -> Column:
    """ln a of a weighted term in a slot."""
    low = F.lit(0xFFFFFFFF).cast("long")

    def product(seed: int) -> Column:
        h = F.xxhash64(F.col(term), F.lit(seed))
        return _uniform(F.shiftrightunsigned(h, 32)) * _uniform(h.bitwiseAND(low))
    r = -F.ln(product(3 * slot))
    ln_c = F.ln(-F.ln(product(3 * slot + 1)))
    beta = _uniform(F.shiftrightunsigned(F.xxhash64(F.col(term), F.lit(3 * slot + 2)), 32))
    return ln_c - r * (F.floor(F.col(log_weight) / r + beta) - beta + F.lit(1.0))


def signatures(texts: DataFrame, keys: list[str], body: str, slots: int = SLOTS) -> DataFrame:
    """``keys`` and ``fingerprint``: ``slots`` groups of 8 hex digits. ``keys`` must tell the texts apart."""
    t = texts.select(*keys, words(body).alias("__h"))
    first = F.filter(F.sequence(F.lit(0), F.size("__h") - 1),
                     lambda i: (i == 0) | (F.get("__h", i) != F.get("__h", i - 1)))
    t = t.withColumn("__at", F.when(F.size("__h") > 0, first))
    terms = F.transform("__at", lambda s, j: F.struct(
        F.get("__h", s).alias("term"), (F.coalesce(F.get("__at", j + 1), F.size("__h")) - s).alias("weight")))
    t = t.select(*keys, F.explode_outer(terms).alias("__t"))
    t = t.select(*keys, F.col("__t.term").alias("__term"), F.ln(F.col("__t.weight")).alias("__lw"))
    least = t.groupBy(*keys).agg(*[F.min(sample("__term", "__lw", i)).alias(f"__s{i}") for i in range(slots)])
    codes = [F.when(F.col(f"__s{i}").isNull(), F.lit("00000000")).otherwise(
        F.lower(F.substring(F.lpad(F.hex(F.xxhash64(F.col(f"__s{i}"))), 16, "0"), 1, 8))) for i in range(slots)]
    return least.select(*keys, F.concat(*codes).alias("fingerprint"))


def likeness(a: str, b: str, slots: int = SLOTS) -> Column:
    """Share of equal slots of two fingerprints."""
    same = F.aggregate(F.sequence(F.lit(0), F.lit(slots - 1)), F.lit(0), lambda n, i: n + F.when(
        F.col(a).substr(i * 8 + 1, F.lit(8)) == F.col(b).substr(i * 8 + 1, F.lit(8)), 1).otherwise(0))
    return same / F.lit(float(slots))


def ring(keys: DataFrame) -> DataFrame:
    """(dk, th, n, copies) with the next key (ndk, nth), the first after the last."""
    parts = shuffle_partitions(keys.sparkSession)
    k = checkpoint(keys.repartitionByRange(parts, "dk", "th").withColumn("pid", F.spark_partition_id()))
    firsts = k.groupBy("pid").agg(F.min(F.struct("dk", "th")).alias("f"))  # a row per partition
    seam = Window.orderBy("pid")
    firsts = firsts.select("pid", F.coalesce(F.lead("f").over(seam), F.first("f").over(
        seam.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    w = Window.partitionBy("pid").orderBy("dk", "th")
    led = k.withColumn("next", F.lead(F.struct("dk", "th")).over(w)).join(F.broadcast(firsts), "pid")
    return led.select("dk", "th", "n", "copies", F.coalesce("next", "after").alias("x")).select(
        "dk", "th", "n", "copies", F.col("x.dk").alias("ndk"), F.col("x.th").alias("nth"))


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """Fingerprints of every text and of its edited text (last quarter replaced by the next text's head)."""
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("dk"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.select("dk", F.xxhash64("text").alias("th"), "text")
    keys = base.select("dk", "th", F.length("text").alias("n")).groupBy("dk", "th", "n").agg(
        F.count("*").alias("copies"))
    order = checkpoint(ring(keys))
    wanted = order.select(F.col("dk").alias("tdk"), F.col("th").alias("tth"), F.floor(F.col("n") / 4).cast("int").alias("q"),
                          F.col("ndk").alias("dk"), F.col("nth").alias("th"))
    heads = base.join(wanted, ["dk", "th"]).select(
        F.col("tdk").alias("dk"), F.col("tth").alias("th"), "q",
        F.expr("substring(text, 1, q)").alias("head")).dropDuplicates(["dk", "th"])
    both = base.join(heads, ["dk", "th"])
    both = both.select("dk", "th", F.length("text").alias("n"), "text", F.concat(
        F.expr("substring(text, 1, length(text) - q)"), F.col("head")).alias("edited"))
    versions = both.select("dk", "th", F.explode(F.array(
        F.struct(F.lit(0).alias("ver"), F.lit("").alias("sha"), F.col("text").alias("body")),
        F.struct(F.lit(1).alias("ver"), F.sha2("edited", 256).alias("sha"), F.col("edited").alias("body")))).alias("v"))
    signed = signatures(versions.select("dk", "th", "v.*"), ["dk", "th", "ver", "sha"], "body", slots)
    signed = signed.groupBy("dk", "th").agg(
        F.max("sha").alias("edited_sha256"),
        F.max(F.when(F.col("ver") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("ver") == 1, F.col("fingerprint"))).alias("edited_fingerprint"))
    signed = checkpoint(signed)
    after = signed.select(F.col("dk").alias("ndk"), F.col("th").alias("nth"), F.col("fingerprint").alias("next_fingerprint"))
    out = signed.join(order, ["dk", "th"]).join(after, ["ndk", "nth"])
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        F.when(F.col("dk") != NO_ID, F.col("dk")).alias("doc_id"), F.col("n").cast("long").alias("n_chars"),
        "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint", slots).alias("near_edited"),
        likeness("fingerprint", "next_fingerprint", slots).alias("near_next"))
