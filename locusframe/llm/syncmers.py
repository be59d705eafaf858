"""Document fingerprints from closed syncmers.

A text is its sequence of words; a word of more than ``LONG`` code points
(prose without blanks, base64, minified lines) stands for all its pieces of
``PIECE`` code points, one from each place. Each run of ``k`` words holds k - s + 1
inner runs of ``s``; the run is a closed syncmer when the inner run with
the smallest hash is its first or its last. The choice looks at the k words
alone, so an edit elsewhere moves no anchor. The fingerprint is the set of all
anchors' 32-bit hashes. Everything is built-in functions.

Two texts are compared by their sets of anchors (``likeness``) and by position
(``aligned``): anchors that both have are matched, and the most common
difference of their places tells how much of the shorter text stands in the
other in one piece. An insertion splits a text into pieces of two
differences; paragraphs in another order are alike but not aligned.

Defined results
* Null text counts as empty. A text without words has an empty fingerprint;
  two empty fingerprints are alike (1.0), an empty and another are not (0.0).
* A text of fewer than k words and pieces is one anchor, so it has at most
  (k - 1) * LONG code points besides blanks; a text with k or more but no
  syncmer is represented by its k-run of smallest hash.
* Repeated doc_ids follow each other by text; null doc_ids come last. A single
  row is its own next document. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusframe.llm.common import body

K, S = 5, 2
LONG, PIECE = 24, 4
SPACE = r"[\x20\x09-\x0D]+"
LOW32 = 0xFFFFFFFF
ROWS_PER_BUCKET, QUANTILES = 4096, 1000


def _words(text: Column) -> Column:
    """Hashes of the words of a text, a long word cut into pieces."""
    words = F.array_remove(F.split(text, SPACE, -1), "")

    def pieces(w: Column) -> Column:
        points = F.array(F.transform(F.split(w, "", -1), lambda c: F.xxhash64(c)))  # bound once by the next lambda
        return F.get(F.transform(points, lambda p: F.transform(
            F.sequence(F.lit(0), F.size(p) - PIECE), lambda i: F.xxhash64(*[F.get(p, i + j) for j in range(PIECE)]))), F.lit(0))

    cut = F.flatten(F.transform(words, lambda w: F.when(F.char_length(w) > LONG, pieces(w)).otherwise(F.array(F.xxhash64(w)))))
    return F.when(F.rlike(text, F.lit(rf"[^\x20\x09-\x0D]{{{LONG + 1}}}")), cut).otherwise(F.transform(words, lambda w: F.xxhash64(w)))


def with_anchors(df: DataFrame, text: str, out: str, k: int = K, s: int = S) -> DataFrame:
    """Adds ``out``: array<struct<pos, hash>>, anchors in text order."""
    def at(c: str, i: Column, j: int) -> Column:
        return F.get(F.col(c), i + j)

    edge = k - s

    def closed(i: Column) -> Column:
        inner = [at("_inner", i, j) for j in range(edge + 1)]
        return (inner[0] <= F.least(*inner[1:])) | (inner[-1] <= F.least(*inner[:-1]))

    def anchor(i: Column) -> Column:
        h = F.xxhash64(*[at("_words", i, j) for j in range(k)]).bitwiseAND(F.lit(LOW32))
        return F.struct(i.alias("pos"), h.alias("hash"))

    n = F.size("_words")
    none = F.expr("cast(array() as array<int>)")
    starts = F.when(n >= k, F.sequence(F.lit(0), n - k)).otherwise(none)
    whole = F.struct(F.lit(0).alias("pos"), F.xxhash64(F.array_join(F.transform("_words", lambda w: w.cast("string")), " "))
                     .bitwiseAND(F.lit(LOW32)).alias("hash"))
    chosen = F.transform("_chosen", anchor)
    lowest = F.array_min(F.transform(F.transform("_starts", anchor), lambda a: F.struct(a["hash"], a["pos"])))
    df = df.withColumn("_words", _words(F.col(text)))
    df = df.withColumn("_inner", F.when(n >= k, F.transform(
        F.sequence(F.lit(0), n - s), lambda i: F.xxhash64(*[at("_words", i, j) for j in range(s)]))))
    df = df.withColumn("_starts", starts).withColumn("_chosen", F.filter("_starts", closed))
    anchors = (F.when(n == 0, F.expr("cast(array() as array<struct<pos:int,hash:bigint>>)"))
               .when(n < k, F.array(whole)).when(F.size("_chosen") > 0, chosen)
               .otherwise(F.array(F.struct(lowest["pos"].alias("pos"), lowest["hash"].alias("hash")))))
    return df.withColumn(out, anchors).drop("_words", "_inner", "_starts", "_chosen")


PLACE_BITS = 30
PLACES, SECOND = (1 << PLACE_BITS) - 1, 1 << PLACE_BITS


def packed(anchors: Column) -> Column:
    """Anchors as whole numbers: hash, a bit for the side, and the place."""
    return F.transform(anchors, lambda a: F.shiftleft(a["hash"], PLACE_BITS + 1) + a["pos"])


def sketch(anchors: Column) -> Column:
    """All distinct hashes of packed anchors, ascending."""
    return F.sort_array(F.array_distinct(F.transform(anchors, lambda a: F.shiftright(a, PLACE_BITS + 1))))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, not in every step of a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def aligned(a: Column, b: Column, smaller: Column) -> Column:
    """Share of the ``smaller`` number of distinct anchors that lie at the most
    common shift between two lists of packed anchors. An anchor that a text
    has more than once counts at its first place."""
    # in one order by hash, a's places falling before b's rising: first places of both lie side by side
    both = F.sort_array(F.concat(F.transform(a, lambda x: x.bitwiseXOR(F.lit(PLACES))), F.transform(b, lambda x: x.bitwiseOR(F.lit(SECOND)))))

    def shift(m: Column, i: Column) -> Column:
        x, y = F.get(m, i), F.get(m, i + 1)
        side = F.shiftright(x, PLACE_BITS)
        met = (side.bitwiseAND(F.lit(1)) == 0) & (F.shiftright(y, PLACE_BITS) == side + 1)
        return F.when(met, y.bitwiseAND(F.lit(PLACES)) - x.bitwiseXOR(F.lit(PLACES)).bitwiseAND(F.lit(PLACES)))

    shifts = _bound(both, lambda m: F.array_compact(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(m) - 2, F.lit(0))), lambda i: shift(m, i))))
    start = F.struct(F.lit(None).cast("long").alias("at"), F.lit(0).alias("n"), F.lit(0).alias("best"))

    def step(s: Column, d: Column) -> Column:
        n = F.when(s["at"] == d, s["n"] + 1).otherwise(1)
        return F.struct(d.alias("at"), n.alias("n"), F.greatest(s["best"], n).alias("best"))

    most = F.aggregate(F.sort_array(shifts), start, step, lambda s: s["best"])
    return F.when(smaller > 0, most / smaller).otherwise(F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(0.0))


def as_string(values: Column) -> Column:
    return F.lower(F.array_join(F.transform(values, lambda v: F.lpad(F.hex(v), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sketches."""
    both = F.size(F.array_intersect(a, b))
    joint = F.size(a) + F.size(b) - both
    return F.when(joint == 0, F.lit(1.0)).otherwise(both / joint)


def _buckets(docs: DataFrame, rows_per_bucket: int) -> tuple[Column, int]:
    """A bucket number that grows with doc_id: at most QUANTILES intervals of
    nearly equal row counts, each cut further into equal widths if there are
    more rows. Null ids get -1."""
    cuts = [i / QUANTILES for i in range(1, QUANTILES)]
    got = docs.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
                   F.percentile_approx("doc_id", cuts, 20 * QUANTILES).alias("q")).first()
    if got["lo"] is None:
        return F.lit(-1).cast("long"), 1
    wanted = max(1, -(-got["n"] // rows_per_bucket))
    step = max(1, QUANTILES // min(wanted, QUANTILES))
    inner = sorted({x for x in got["q"][step - 1::step] if got["lo"] < x <= got["hi"]})
    lows = [got["lo"], *inner]
    widths = [b - a for a, b in zip(lows, [*inner, got["hi"] + 1], strict=True)]
    fine = max(1, -(-wanted // len(lows)))
    at = F.size(F.filter(F.array(*[F.lit(x) for x in inner]), lambda c: c <= F.col("doc_id"))) if inner else F.lit(0)
    low = F.get(F.array(*[F.lit(x) for x in lows]), at)
    width = F.get(F.array(*[F.lit(x) for x in widths]), at)
    part = F.floor((F.col("doc_id") - low).cast("decimal(38,0)") * fine / width).cast("long") if fine > 1 else F.lit(0)
    return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(at * fine + part).cast("long"), len(lows) * fine


def dealt(docs: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """doc_id, text, ``_bucket`` and ``_copy``: the documents dealt by ranges
    of doc_id, and into each range a copy (``_copy`` 1) of the first row of
    the range below it; the lowest range gets that of the highest."""
    bucket, _ = _buckets(docs, rows_per_bucket)
    rows = docs.select("doc_id", body().alias("text")).withColumn("_bucket", bucket)
    heads = docs.select("doc_id").withColumn("_bucket", bucket).groupBy("_bucket").agg(F.max("doc_id").alias("_head"))
    up = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # a row per bucket
    above = heads.select("_bucket", "_head", F.coalesce(
        F.lead("_bucket").over(Window.orderBy("_bucket")), F.first("_bucket").over(up)).alias("_to"))
    copies = (rows.join(F.broadcast(above.withColumnRenamed("_bucket", "_of")), (F.col("_bucket") == F.col("_of"))
                        & F.col("doc_id").eqNullSafe(F.col("_head")))
              .groupBy("_to").agg(F.min("text").alias("text"))
              .select(F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "text",
                      F.col("_to").alias("_bucket"), F.lit(1).alias("_copy")))
    return rows.withColumn("_copy", F.lit(0)).unionByName(copies)


def fingerprints(docs: DataFrame, k: int = K, s: int = S, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Per document: doc_id, text, ``anchors`` (packed); and ``next`` (text, anchors) of
    the next row in descending doc_id order, after the last row the first."""
    rows = dealt(docs, rows_per_bucket).repartition("_bucket")  # texts alone are shuffled, anchors are not
    rows = with_anchors(rows, "text", "_a", k, s).withColumn("anchors", packed(F.col("_a")))
    w = Window.partitionBy("_bucket").orderBy("_copy", F.desc("doc_id"), "text")
    nxt = F.struct(F.lead("text").over(w).alias("text"), F.lead("anchors").over(w).alias("anchors"))
    return rows.drop("_a").withColumn("next", nxt).filter("_copy = 0").drop("_bucket", "_copy")


def edited(df: DataFrame) -> DataFrame:
    """Adds ``n_chars`` and ``edited``: the last half of the text replaced by
    as many code points of the next text (or all it has)."""
    half = F.floor(F.col("n_chars") / 2).cast("int")
    return df.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("edited", F.concat(
        F.substr("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substr(F.col("next.text"), F.lit(1), half)))


def compare_edits(docs: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they
    and the next document's fingerprint are."""
    df = with_anchors(edited(fingerprints(docs, rows_per_bucket=rows_per_bucket)), "edited", "_a").withColumn("_e", packed(F.col("_a")))
    df = df.withColumns({"sketch": sketch(F.col("anchors")), "_es": sketch(F.col("_e")), "_ns": sketch(F.col("next.anchors"))})
    own, there, then = F.col("sketch"), F.col("_es"), F.col("_ns")
    return df.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                     as_string(own).alias("fingerprint"), as_string(there).alias("edited_fingerprint"),
                     likeness(own, there).alias("near_edited"), likeness(own, then).alias("near_next"),
                     aligned(F.col("anchors"), F.col("_e"), F.least(F.size(own), F.size(there))).alias("aligned_edited"),
                     aligned(F.col("anchors"), F.col("next.anchors"), F.least(F.size(own), F.size(then))).alias("aligned_next"))
