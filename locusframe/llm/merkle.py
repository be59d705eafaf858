"""Merkle manifest of a table, with leaf coordinates from bitmap ranks.

Rows are leaves; leaves of one source ascend by doc_id; every ``FAN``
consecutive nodes become their parent until one node remains, the subroot;
subroots in the order of their sources give the root in the same way.

Where a leaf stands is looked up, leaves are never sorted. Per source, doc_ids
are a two-level compressed bitmap: 64 ids a word, and 64 words a container of
which only the words in use are kept, behind a header bit each. Words and
headers are merged by ``bit_or``, map-side first. A popcount directory holds the rows before
each word of a container, and a prefix scan over containers the rows before
each container. The rank of an id is then two array reads and two bit counts.

With coordinates, nodes are keyed by (group, index div FAN ** BLOCK_LEVELS)
into slot arrays of bounded size. A task hashes BLOCK_LEVELS levels of an array
at once and sends one node up, so a table of any size needs a few rounds. On
the way down every array meets the path of its top node, and each leaf gets its
proof and the root folded from it.

Defined results
* A null field is ``-``; others are byte count, ``:`` and value. Null doc_ids
  come first in their source, the null source comes first of all.
* Rows with one (source, doc_id) follow each other by leaf; equal rows stand
  side by side, each with a place of its own.
* ``altered`` rows get the leaf of their altered content for folding.
* An empty table gives no rows. Columns beyond the listed fields are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.llm.common import lookup, settings, stored
from locusframe.operators.scan import prefix_scan, row_index

FAN, BLOCK_LEVELS = 3, 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Slot arrays are some 100 KB a row: they go to Python a few at a time.
FEW_ROWS = {"spark__sql__execution__arrow__maxRecordsPerBatch": "32"}
NODES = "grp string, idx bigint, n bigint, hash string"
PATHS = "grp string, idx bigint, slots array<int>, runs array<string>, top string"


def leaf_hash(fields: dict[str, Column]) -> Column:
    """Hex SHA-256 over all fields, each told apart by its length."""
    def item(c: Column) -> Column:
        s = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))

    return F.sha2(F.concat(*[item(c) for c in fields.values()]), 256)


def leaves(docs: DataFrame, alter: Column | None = None, altered_text: Column | None = None) -> DataFrame:
    """doc_id, grp (the source), leaf, and ``altered``: the leaf with
    ``altered_text`` in rows where ``alter`` holds, else null."""
    fields = {c: F.col(c) for c in FIELDS}
    changed = F.lit(None).cast("string")
    if alter is not None:
        changed = F.when(alter, leaf_hash(fields | {"text": altered_text}))
    return docs.select("doc_id", F.col("source").alias("grp"), leaf_hash(fields).alias("leaf"), changed.alias("altered"))


def _key() -> Column:
    return F.struct(F.col("grp"), F.shiftright(F.col("doc_id"), 12).alias("hi"))


def _word() -> Column:
    """Number of an id's word in its container; the null id is the only one of its container."""
    return F.coalesce(F.shiftright(F.col("doc_id"), 6).bitwiseAND(F.lit(63)), F.lit(0).cast("long")).cast("int")


def _bit() -> Column:
    return F.coalesce(F.col("doc_id").bitwiseAND(F.lit(63)), F.lit(0).cast("long")).cast("int")


def _flag(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at)


def bitmap_index(rows: DataFrame) -> DataFrame:
    """Per container: key (grp, hi), header, words (used ones, each with its
    bits, the rows before it, and ids that occur more than once), weight (its
    rows) and before (rows of the group in earlier containers)."""
    ids = rows.groupBy("grp", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
    more = F.when(F.col("copies") > 1, F.struct(_bit().alias("bit"), (F.col("copies") - 1).alias("extra")))
    words = ids.withColumn("key", _key()).groupBy("key", _word().alias("word")).agg(
        F.bit_or(_flag(_bit())).alias("bits"), F.sum("copies").alias("rows"), F.collect_list(more).alias("extras"))
    boxes = words.groupBy("key").agg(
        F.bit_or(_flag(F.col("word"))).alias("header"), F.sum("rows").alias("weight"),
        F.sort_array(F.collect_list(F.struct("word", "bits", "rows", "extras"))).alias("used"))
    # at most 64 words: the running sum over them is short
    before = F.transform("used", lambda w, i: F.struct(
        w["bits"].alias("bits"), w["extras"].alias("extras"),
        F.aggregate(F.slice(F.col("used"), F.lit(1), i), F.lit(0).cast("long"), lambda a, x: a + x["rows"]).alias("rank")))
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    boxes = boxes.select("key", "header", "weight", before.alias("words"), "key.grp", "key.hi")
    dealt = stored(boxes.repartitionByRange(parts, "grp", "hi").withColumn("part", F.spark_partition_id()), "bitmap-boxes")
    return prefix_scan(dealt, ["grp"], ["part"], ["hi"], F.col("weight"), inclusive=False, out="before").select(
        "key", "header", "words", "weight", "before")


def _below(bits: Column, at: Column) -> Column:
    """Number of set bits under place ``at``."""
    above = F.call_function("shiftleft", F.lit(-1).cast("long"), at)
    return F.bit_count(bits.bitwiseAND(F.bitwise_not(above)))


def with_rank(rows: DataFrame) -> DataFrame:
    """Adds ``idx``: the place of each row in its group, by doc_id."""
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    found = lookup(rows.withColumn("key", _key()), bitmap_index(rows), "key", "weight", total)
    word = F.get("words", _below(F.col("header"), _word()))
    twice = F.filter(word["extras"], lambda e: e["bit"] < _bit())
    rank = (F.col("before") + word["rank"] + _below(word["bits"], _bit())
            + F.aggregate(twice, F.lit(0).cast("long"), lambda a, e: a + e["extra"]))
    shared = F.exists(word["extras"], lambda e: e["bit"] == _bit())
    found = stored(found.select(*rows.columns, rank.alias("idx"), shared.alias("shared")), "leaf-ranks")
    same = found.filter("shared").withColumn("_head", F.substring("leaf", 1, 4))
    # rows of one (source, doc_id): their order by leaf, in slices of its first digits
    placed = row_index(same, ["grp", "doc_id"], ["_head"], ["leaf"], "_nth").withColumn("idx", F.col("idx") + F.col("_nth"))
    return found.filter("NOT shared").drop("shared").unionByName(placed.drop("shared", "_head", "_nth"))


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(n: int) -> int:
    """Levels above ``n`` nodes."""
    k = 0
    while n > 1:
        n, k = -(-n // FAN), k + 1
    return k


def climb(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes and ``levels`` levels above them."""
    out = [list(nodes)]
    for _ in range(levels):
        low = out[-1]
        out.append([_h("".join(low[i:i + FAN])) for i in range(0, len(low), FAN)])
    return out


def path(tree: list[list[str]], i: int) -> tuple[list[int], list[str]]:
    """Per level the slot of node ``i`` in its run, and its siblings' text."""
    slots, runs = [], []
    for level in tree[:-1]:
        j = i - i % FAN
        slots.append(i - j)
        runs.append("".join(level[j:i] + level[i + 1:j + FAN]))
        i //= FAN
    return slots, runs


def fold(node: str, slots: list[int], runs: list[str]) -> str:
    for s, run in zip(slots, runs, strict=True):
        node = _h(run[:64 * s] + node + run[64 * s:])
    return node


def _rows(it: Iterator[pd.DataFrame]):
    for b in it:
        yield from b.to_dict("records")


def _slot_arrays(nodes: DataFrame, keep: list[str]) -> DataFrame:
    """Nodes keyed by block: one row of at most FAN ** BLOCK_LEVELS slots."""
    width = FAN ** BLOCK_LEVELS
    block, slot = F.expr(f"idx div {width}"), F.expr(f"cast(idx % {width} as int)")
    return nodes.groupBy("grp", block.alias("idx"), "n").agg(
        F.sort_array(F.collect_list(F.struct(slot.alias("slot"), *keep))).alias("s")).select(
        "grp", "idx", "n", *[F.col(f"s.{c}").alias(c) for c in keep])


def _up(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in it:
        out = []
        for r in b.to_dict("records"):
            tree = climb(r["hash"], min(BLOCK_LEVELS, levels_of(r["n"])))
            out.append((r["grp"], r["idx"], -(-r["n"] // FAN ** BLOCK_LEVELS), tree[-1][0]))
        yield pd.DataFrame(out, columns=["grp", "idx", "n", "hash"])


def _down(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    width = FAN ** BLOCK_LEVELS
    for b in it:
        for r in b.to_dict("records"):
            tree = climb(r["hash"], min(BLOCK_LEVELS, levels_of(r["n"])))
            got = [path(tree, i) for i in range(len(tree[0]))]
            yield pd.DataFrame({
                "grp": r["grp"], "idx": [r["idx"] * width + i for i in range(len(got))],
                "slots": [s + list(r["slots"]) for s, _ in got], "runs": [x + list(r["runs"]) for _, x in got],
                "top": r["top"]})


def _joined(blocks: DataFrame, tops: DataFrame) -> DataFrame:
    t = tops.select(F.col("grp").alias("_g"), F.col("idx").alias("_i"), "slots", "runs", "top")
    return blocks.join(t, blocks["grp"].eqNullSafe(t["_g"]) & (blocks["idx"] == t["_i"])).drop("_g", "_i")


def reduce_levels(blocks: DataFrame) -> DataFrame:
    """For slot arrays (grp, idx, n, hash): the path (PATHS) from the top node
    of each array to the top of its group."""
    spark = blocks.sparkSession
    rounds, at = [], blocks
    most = blocks.agg(F.max("n").alias("n")).first()["n"] or 0
    while True:
        with settings(spark, **FEW_ROWS):
            nodes = stored(at.select("grp", "idx", "n", "hash").mapInPandas(_up, NODES), "merkle-nodes")
        most = -(-most // FAN ** BLOCK_LEVELS)
        if most <= 1:
            break
        at = stored(_slot_arrays(nodes, ["hash"]), "merkle-blocks")
        rounds.append(at)
    none = "cast(array() as array<{}>)"
    paths = nodes.select("grp", "idx", F.expr(none.format("int")).alias("slots"), F.expr(none.format("string")).alias("runs"),
                         F.col("hash").alias("top"))
    for at in reversed(rounds):
        with settings(spark, **FEW_ROWS):
            paths = stored(_joined(at, paths).mapInPandas(_down, PATHS), "merkle-paths")
    return paths


def _ordered_groups(tops: DataFrame) -> DataFrame:
    """Subroots as nodes of one tree, in the order of their groups."""
    parts = max(int(tops.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    dealt = stored(tops.repartitionByRange(parts, "grp").withColumn("part", F.spark_partition_id()), "merkle-groups")
    n = dealt.agg(F.count(F.lit(1)).alias("n"))
    return row_index(dealt, [], ["part"], ["grp"], "idx").crossJoin(F.broadcast(n)).withColumnRenamed("grp", "name").select(
        F.lit("").alias("grp"), "idx", "n", "name", F.col("top").alias("hash"))


def manifest(rows: DataFrame) -> DataFrame:
    """Per leaf of ``leaves``: doc_id, leaf, subroot, root, proof (siblings
    from leaf to root, as one text's SHA-256), folded_root and verified."""
    spark = rows.sparkSession
    rows = stored(rows, "merkle-leaves")
    ranked = with_rank(rows)
    sizes = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("grp", "_g")
    # ids travel as text: an array of numbers with nulls among them would reach Python as floats
    packed = _slot_arrays(ranked.withColumn("n", F.lit(0).cast("long")).withColumn("doc_id", F.col("doc_id").cast("string")),
                          ["doc_id", "leaf", "altered"]).drop("n")
    blocks = stored(packed.join(sizes, packed["grp"].eqNullSafe(sizes["_g"])).drop("_g"), "merkle-leaf-blocks")
    paths = reduce_levels(blocks.withColumnRenamed("leaf", "hash"))
    tops = paths.select("grp", "top").distinct()
    groups = stored(_ordered_groups(tops), "merkle-subroots")
    group_paths = reduce_levels(stored(_slot_arrays(groups, ["name", "hash"]), "merkle-group-blocks"))
    # from the subroots' arrays down to each subroot
    with settings(spark, **FEW_ROWS):
        over = stored(_joined(_slot_arrays(groups, ["hash"]), group_paths).mapInPandas(_down, PATHS), "merkle-group-paths")
    named = over.join(groups.select("idx", "name"), "idx").select(
        F.col("name").alias("_g"), F.col("slots").alias("_slots"), F.col("runs").alias("_runs"), F.col("top").alias("root"))
    whole = paths.join(named, paths["grp"].eqNullSafe(named["_g"])).select(
        "grp", "idx", F.concat("slots", "_slots").alias("slots"), F.concat("runs", "_runs").alias("runs"), "top", "root")
    t = whole.withColumnRenamed("grp", "_g").withColumnRenamed("idx", "_i")
    todo = blocks.join(t, blocks["grp"].eqNullSafe(t["_g"]) & (blocks["idx"] == t["_i"])).drop("_g", "_i", "grp", "idx")

    def prove(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for r in _rows(it):
            tree = climb(r["leaf"], min(BLOCK_LEVELS, levels_of(r["n"])))
            out = []
            for i, (d, leaf, altered) in enumerate(zip(r["doc_id"], r["leaf"], r["altered"], strict=True)):
                slots, runs = path(tree, i)
                slots, runs = slots + list(r["slots"]), runs + list(r["runs"])
                folded = fold(leaf if altered is None else altered, slots, runs)
                out.append((d, leaf, r["top"], r["root"], _h("".join(runs)), folded, folded == r["root"]))
            yield pd.DataFrame(out, columns=columns)

    schema = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    columns = [c.split()[0] for c in schema.split(", ")]
    with settings(spark, **FEW_ROWS):
        return stored(todo.mapInPandas(prove, schema).withColumn("doc_id", F.col("doc_id").cast("long")), "merkle-manifest")
