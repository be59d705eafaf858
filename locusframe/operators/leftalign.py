"""Left-alignment of insertions and deletions against the reference sequence.

The reference is a table of windows (contig, win, seq_start, seq): window
``win`` ends at base ``(win + 1) * width`` and starts ``halo`` bases before its
own first base, so a variant at any place of a window has at least ``halo``
bases to its left, or all that the contig has. An indel of the bases D after
anchor p can move left as long as the reference, read leftwards from p, repeats
D; the shift is therefore the length of a common suffix of the sequence up to p and of D
repeated. It is found by bisection on built-in string functions. A shift that
uses up a window goes on in the next one, as a new round over the rows still
moving; each round is one equi-join on (contig, win).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.operators.reshape import normalize_trim
from locusframe.session import cut_lineage

WIDTH, HALO = 16_384, 1_024


def reference_windows(pieces: DataFrame, width: int = WIDTH, halo: int = HALO) -> DataFrame:
    """Windows from adjoining pieces of sequence (contig, start, seq; 1-based,
    of any lengths, without gaps or overlaps). A piece is cut into the parts
    that windows need before it is sent, so a window gathers at most
    ``width + halo`` bases whatever the pieces are."""
    first, last = F.col("start"), F.col("start") + F.length("seq") - 1
    wins = F.sequence(F.expr(f"(start - 1) div {width}"), ((last - 1 + halo) / width).cast("long"))
    near = pieces.where(F.length("seq") > 0).select("contig", "start", "seq", F.explode(wins).alias("win"))
    lo = F.greatest(first, F.col("win") * width + 1 - halo)
    hi = F.least(last, (F.col("win") + 1) * width)
    part = F.substring(F.col("seq"), (lo - first + 1).cast("int"), (hi - lo + 1).cast("int"))
    cut = near.where(hi >= lo).select("contig", "win", lo.alias("at"), F.upper(part).alias("part"))
    got = cut.groupBy("contig", "win").agg(F.sort_array(F.collect_list(F.struct("at", "part"))).alias("p"))
    return got.select("contig", "win", F.col("p")[0]["at"].alias("seq_start"),
                      F.array_join(F.col("p.part"), "").alias("seq"))


def _events(variants: DataFrame) -> DataFrame:
    """Adds the anchor ``_p`` (base before the event) and the bases ``_d`` of
    an insertion or deletion; both null for anything else."""
    d = normalize_trim(variants)
    ref, alt = F.col("ref"), F.col("alt")
    long = F.when(F.length(ref) > F.length(alt), ref).otherwise(alt)
    short = F.when(F.length(ref) > F.length(alt), alt).otherwise(ref)
    plain = (F.length(short) == 1) & (F.length(long) > 1) & F.concat(ref, alt).rlike("^[ACGTNacgtn]+$")
    starts = plain & (F.substring(long, 1, 1) == short)
    ends = plain & ~starts & (F.right(long, F.lit(1)) == short) & (F.col("pos") > 1)
    return d.withColumns({
        "_d": F.upper(F.when(starts, F.expr("substring(if(length(ref) > length(alt), ref, alt), 2)"))
                      .when(ends, F.left(long, F.length(long) - 1))),
        "_p": F.when(starts, F.col("pos")).when(ends, F.col("pos") - 1).cast("long"),
        "_del": F.length(ref) > F.length(alt)})


def _common_suffix(a: Column, b: Column, most: Column, bits: int) -> Column:
    """Length, up to ``most``, of the longest common suffix, by bisection:
    suffixes of equal suffixes are equal."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda k, s: F.when(
        (k + s <= most) & (F.right(a, k + s) == F.right(b, k + s)), k + s).otherwise(k))


def _shift(moving: DataFrame, windows: DataFrame, width: int, halo: int) -> DataFrame:
    """One round: the anchor moves left within its window. ``_open`` says that
    the window, not the sequence, ended the move; ``_base`` is the anchor's base."""
    w = windows.select(F.col("contig").alias("_c"), F.col("win").alias("_w"), "seq_start", "seq")
    j = moving.join(w, (F.col("contig") == F.col("_c")) & (F.expr(f"(_p - 1) div {width}") == F.col("_w")), "left")
    left = F.col("_p") - F.col("seq_start")  # bases left of the anchor that the window holds
    j = j.withColumn("_left", left.cast("int")).withColumn(
        "_ctx", F.expr("substring(seq, 1, _left + 1)")).withColumn(
        "_rep", F.expr("right(repeat(_d, cast(ceil(_left / length(_d)) as int) + 1), _left + 1)"))
    k = F.coalesce(_common_suffix(F.col("_ctx"), F.col("_rep"), F.col("_left"), (width + halo).bit_length()), F.lit(0))
    j = j.withColumn("_k", k).withColumn("_turn", F.expr("_k % length(_d)"))
    return j.withColumns({
        "_d": F.expr("concat(right(_d, _turn), left(_d, length(_d) - _turn))"),
        "_p": F.col("_p") - F.col("_k"),
        "_base": F.expr("substring(seq, _left + 1 - _k, 1)"),
        "_open": F.coalesce((F.col("_k") == F.col("_left")) & (F.col("_k") > 0) & (F.col("seq_start") > 1), F.lit(False)),
    }).drop("_c", "_w", "seq_start", "seq", "_left", "_ctx", "_rep", "_k", "_turn")


def left_align(variants: DataFrame, windows: DataFrame, width: int = WIDTH, halo: int = HALO) -> DataFrame:
    """Trimmed, left-aligned biallelic variants (contig, pos, ref, alt and any
    other columns). Substitutions, symbolic alleles, and variants outside the
    windows are trimmed only. An event never moves past base 1, which stays
    its anchor. ``width`` and ``halo`` are those of the windows."""
    if halo < 1:
        raise ValueError("windows need a halo: a shift over a window's edge goes on from there")
    cols = variants.columns
    ev = _events(variants)
    fixed = ev.where(F.col("_d").isNull()).select(*cols)
    moving = ev.where(F.col("_d").isNotNull())
    done = []
    while True:
        moved = cut_lineage(_shift(moving, windows, width, halo))
        done.append(moved.where("NOT _open"))
        moving = moved.where("_open").drop("_base", "_open")
        if moving.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    base, event = F.col("_base"), F.concat("_base", "_d")
    known = base.isNotNull() & (base != "")
    aligned = out.select(*[c for c in cols if c not in ("pos", "ref", "alt")],
                         F.when(known, F.col("_p")).otherwise(F.col("pos")).cast(variants.schema["pos"].dataType).alias("pos"),
                         F.when(~known, F.col("ref")).when(F.col("_del"), event).otherwise(base).alias("ref"),
                         F.when(~known, F.col("alt")).when(F.col("_del"), base).otherwise(event).alias("alt"))
    return fixed.unionByName(aligned.select(*cols))
