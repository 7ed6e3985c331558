"""Exact duplicates by deterministic naming of fixed-size blocks.

Equal blocks get equal integer names, equal pairs of adjacent names get equal names, and so on
until each document has one name: two documents share it exactly when their texts are equal.
Names come from sorting the blocks themselves, so no hash can merge different texts.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS_RUN, let, written

KEY = ["doc_id", "variant"]
# Blocks are dealt to ranges by their first bytes: the driver samples these, not whole blocks.
RANGE_BYTES = 32


def _names(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """Distinct values of ``cols`` in sorted order with an integer name each."""
    ranges = [F.substring(c, 1, RANGE_BYTES) if c == "block" else F.col(c) for c in cols]
    ranked = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).drop("_n")
              .repartitionByRange(*ranges).sortWithinPartitions(*cols))
    return written(ranked.withColumn("name", F.monotonically_increasing_id()), label)


def _normal(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WS_RUN, " ")


def _blocks(normal: Column, size: int) -> Column:
    """The UTF-8 bytes of a text in blocks of ``size``; an empty text is one empty block."""
    return let(normal.cast("binary"), lambda b: F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.octet_length(b) - 1) / size))
                   .cast("int")),
        lambda i: F.substring(b, i * size + 1, F.lit(size))))


def _pair_up(level: DataFrame, depth: int) -> DataFrame:
    """Name the pairs of adjacent names; an odd last name is paired with -1."""
    half = F.floor(F.col("pos") / 2).cast("int")
    even = F.col("pos") % 2 == 0
    pairs = written(level.groupBy(*KEY, half.alias("half"), "width").agg(
        F.max(F.when(even, F.col("name"))).alias("left"),
        F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("right")),
        f"pairs{depth}")
    named = _names(pairs, ["left", "right"], f"pair-names{depth}")
    return written(pairs.join(named, ["left", "right"]).select(
        *KEY, F.col("half").alias("pos"), F.ceil(F.col("width") / 2).cast("int").alias("width"),
        "name"), f"level{depth}")


def text_variant(text: Column) -> Column:
    """What tells the different texts of one id apart in ``exact_groups``."""
    return F.xxhash64(_normal(text))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = 4096) -> DataFrame:
    """One row per document with the id that stays, the group's size and the text's digest.

    Besides the result: ``times`` (rows of the document) and ``variant`` (see ``text_variant``).

    Texts are compared after each white-space run became one space; null counts as empty, and all
    empty texts are equal.  A block whose fingerprint nobody shares differs from every other block,
    which settles its document; all others go through the naming.

    Rows with the same id and text are one document and give one row; ``group_size`` counts rows.
    Rows with one id and different texts are different documents.  Null ids lose against any id and
    stay (keep_id null) only where a group has no other.  An empty table gives no rows; other
    columns are not read.
    """
    normal = docs.select(F.col(id_col).alias("doc_id"), _normal(F.col(text_col)).alias("normal"))
    base = normal.select("doc_id", F.xxhash64("normal").alias("variant"), "normal")
    listed = written(base.select(*KEY, F.sha2("normal", 256).alias("text_sha256"))
                     .groupBy(*KEY).agg(F.min("text_sha256").alias("text_sha256"),
                                        F.count(F.lit(1)).alias("times")), "exact-rows")

    # A fingerprint that occurs once in the corpus proves that its block does too.
    prints = base.select(*KEY, F.explode(F.transform(
        _blocks(F.col("normal"), block_bytes), lambda b: F.xxhash64(b))).alias("print"))
    once = (prints.groupBy("print").agg(F.count(F.lit(1)).alias("n"),
                                        F.min(F.struct(*KEY)).alias("owner"))
            .filter("n = 1").select("owner.*"))
    alone = once.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    a, b = listed.select(*KEY).alias("a"), alone.alias("b")
    open_keys = written(a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (
        F.col("a.variant") == F.col("b.variant")), "left_anti"), "exact-open")
    # A merge join at every size: the list of open documents grows with the input, so it is not
    # broadcast where it happens to be small.
    o = open_keys.hint("merge").alias("o")
    open_docs = base.alias("t").join(
        o, F.col("t.doc_id").eqNullSafe(F.col("o.doc_id")) & (
            F.col("t.variant") == F.col("o.variant")), "left_semi")

    parts = written(open_docs.select(*KEY, _blocks(F.col("normal"), block_bytes).alias("blocks"))
                    .select(*KEY, F.size("blocks").alias("width"),
                            F.posexplode("blocks").alias("pos", "block"))
                    .groupBy(*KEY, "pos", "width", "block").agg(F.count(F.lit(1)).alias("_n"))
                    .drop("_n"), "exact-blocks")
    named = _names(parts, ["block"], "block-names")
    level = written(parts.join(named, "block").select(*KEY, "pos", "width", "name"), "level0")
    widest = level.agg(F.max("width")).first()[0] or 0
    done, depth = [], 0
    while True:
        done.append(level.filter("width = 1").select(*KEY, F.lit(depth).alias("depth"), "name"))
        if widest <= 1:
            break
        depth += 1
        widest = (widest + 1) // 2
        level = _pair_up(level.filter("width > 1"), depth)
    roots = reduce(DataFrame.unionByName, done)

    l, r = listed.alias("l"), roots.alias("r")
    same = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (
        F.col("l.variant") == F.col("r.variant"))
    members = written(l.join(r, same).select("l.doc_id", "l.variant", "times", "depth", "name"),
                      "exact-roots")
    groups = written(members.groupBy("depth", "name").agg(
        F.min("doc_id").alias("keep_id"), F.sum("times").alias("group_size"),
        F.count(F.lit(1)).alias("texts")).filter("texts > 1").drop("texts"), "exact-groups")
    joined = members.join(groups, ["depth", "name"]).select(
        F.col("doc_id").alias("_id"), F.col("variant").alias("_variant"), "keep_id", "group_size")
    out = listed.join(joined, F.col("doc_id").eqNullSafe(F.col("_id")) & (
        F.col("variant") == F.col("_variant")), "left")
    grouped = F.col("group_size").isNotNull()
    keep = F.when(grouped, F.col("keep_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", keep.alias("keep_id"),
                      F.coalesce("group_size", "times").cast("long").alias("group_size"),
                      F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256", "times",
                      "variant")
