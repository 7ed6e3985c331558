"""Merkle manifest of a table: Merkle trees a group and over the groups, on concatenated levels.

Rows are ranked inside their group and dealt to aligned blocks of ``FAN ** DEPTH`` leaves.  A block
keeps each level of its part of the tree as one string of hexadecimal digests (as bytes, so that a
fixed-width substring costs its own length): the parent of run i is the hash of substring i, and
the substrings on both sides of a node in its run are its siblings.  The blocks' roots are the
leaves of the next round, so rounds grow with the logarithm of the largest group.  Proofs are put
together on the way down: a block's node takes its own flanks and those of its block's root.
"""
from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

FAN, DEPTH, HEX = 8, 3, 64
BLOCK = FAN ** DEPTH
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FLANKS = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(values: Iterable[Column]) -> Column:
    """The leaf of a row: the hash of its fields one after the other."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _ranked(rows: DataFrame, group: str, order: list[str], label: str) -> DataFrame:
    """Add ``pos`` (from 0) and ``total`` of each row's group, groups and rows by range."""
    cols = [group, *order]
    placed = written(rows.repartitionByRange(*cols).sortWithinPartitions(*cols)
                     .withColumn("at", F.monotonically_increasing_id())
                     .withColumn("part", F.shiftright("at", 33)), label)
    held = placed.groupBy(F.col(group).alias("_group"), F.col("part").alias("_part")).agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("held"))
    whole = Window.partitionBy("_group")
    ahead = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("_group", "_part", "first", F.sum("held").over(whole).alias("total"),
                         F.coalesce(F.sum("held").over(ahead), F.lit(0)).alias("before"))
    same = (F.col("part") == F.col("_part")) & F.col(group).eqNullSafe(F.col("_group"))
    return placed.join(starts, same).select(
        *rows.columns, (F.col("at") - F.col("first") + F.col("before")).alias("pos"), "total")


def _parents(level: Column) -> Column:
    """The digests of all runs of ``FAN`` nodes of a level, one after the other."""
    run = FAN * HEX
    return F.array_join(F.transform(
        F.sequence(F.lit(0), F.floor((F.octet_length(level) - 1) / run).cast("int")),
        lambda i: F.sha2(F.substring(level, i * run + 1, F.lit(run)), 256)), "").cast("binary")


def _blocks(nodes: DataFrame, carry: list[str], label: str) -> DataFrame:
    """Nodes (grp, pos, total, digest, carry) to blocks with their levels and ``top``, their root.

    A level exists where the group has more than one node on the level below.
    """
    out = nodes.groupBy("grp", F.floor(F.col("pos") / BLOCK).alias("block"), "total").agg(
        F.sort_array(F.collect_list(F.struct(
            F.pmod("pos", F.lit(BLOCK)).cast("int").alias("slot"), "digest", *carry))).alias("kept"))
    out = out.withColumn("level0", F.array_join(F.col("kept.digest"), "").cast("binary"))
    for j in range(1, DEPTH + 1):
        out = out.withColumn(f"level{j}", F.when(
            F.col("total") > FAN ** (j - 1), _parents(F.col(f"level{j - 1}"))))
    levels = [F.col(f"level{j}") for j in range(DEPTH, -1, -1)]
    items = F.transform("kept", lambda x: F.struct(x["slot"], *[x[c].alias(c) for c in carry]))
    return written(out.select(
        "grp", "block", "total", F.coalesce(*levels).cast("string").alias("top"),
        items.alias("items"), *[f"level{j}" for j in range(DEPTH)]), label)


def _flanks(level: Column, own: Column) -> Column:
    """Both sides of node ``own`` in its run."""
    first = own - F.pmod(own, F.lit(FAN))
    return F.struct(
        F.substring(level, first * HEX + 1, (own - first) * HEX).cast("string").alias("left"),
        F.substring(level, (own + 1) * HEX + 1, (first + (FAN - 1) - own) * HEX)
        .cast("string").alias("right"))


def _opened(blocks: DataFrame, above: DataFrame, carry: list[str], known: list[str]) -> DataFrame:
    """The blocks' nodes with their flanks up to the top and what ``above`` knows of their block."""
    a = above.withColumnsRenamed({"grp": "_grp", "pos": "_pos"})
    met = blocks.join(a, blocks["grp"].eqNullSafe(a["_grp"]) & (blocks["block"] == a["_pos"]))
    each = met.select("grp", "block", "total", *[f"level{j}" for j in range(DEPTH)], "path", *known,
                      F.explode("items").alias("x"))
    slot = F.col("x.slot")
    own = [F.when(F.col("total") > FAN ** j, _flanks(
        F.col(f"level{j}"), F.floor(slot / FAN ** j).cast("int"))) for j in range(DEPTH)]
    below = F.filter(F.array(*own), lambda s: s.isNotNull())
    return each.select(
        "grp", (F.col("block") * BLOCK + slot).alias("pos"),
        F.substring("level0", slot * HEX + 1, F.lit(HEX)).cast("string").alias("digest"),
        F.concat(below, F.col("path")).alias("path"), *known,
        *[F.col(f"x.{c}").alias(c) for c in carry])


def _climb(nodes: DataFrame, carry: list[str], label: str) -> tuple[list[DataFrame], DataFrame]:
    """All rounds of blocks, and each group's root (grp, top)."""
    rounds = [_blocks(nodes, carry, f"{label}0")]
    widest = rounds[0].agg(F.max("total")).first()[0] or 0
    while widest > BLOCK:
        widest = -(-widest // BLOCK)
        below = rounds[-1].filter(F.col("total") > BLOCK)
        rounds.append(_blocks(below.select(
            "grp", F.col("block").alias("pos"),
            F.ceil(F.col("total") / BLOCK).cast("long").alias("total"),
            F.col("top").alias("digest")), [], f"{label}{len(rounds)}"))
    done = [r.filter(F.col("total") <= BLOCK).select("grp", "top") for r in rounds]
    return rounds, reduce(DataFrame.unionByName, done)


def _descend(rounds: list[DataFrame], tops: DataFrame, carry: list[str],
             known: list[str]) -> DataFrame:
    """The first round's nodes with their paths; ``tops`` has grp, path and ``known``."""
    tops = tops.withColumn("pos", F.lit(0).cast("long"))
    opened = None
    for i in range(len(rounds) - 1, -1, -1):
        ends = rounds[i].filter(F.col("total") <= BLOCK).select(F.col("grp").alias("_of"))
        above = tops.join(ends, F.col("grp").eqNullSafe(F.col("_of"))).drop("_of")
        if opened is not None:
            above = above.unionByName(opened.select("grp", "pos", "path", *known))
        opened = _opened(rounds[i], above, carry if i == 0 else [], known)
    return opened


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with its path's siblings."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(
        F.concat(s["left"], node, s["right"]), 256))


def merkle_manifest(docs: DataFrame, fields: list[str], group_col: str = "lang",
                    id_col: str = "doc_id", carry: dict[str, Column] | None = None) -> DataFrame:
    """Per row: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``path`` and the columns ``carry``.

    ``path`` lists the siblings (text to the left and to the right of the node in its run) of each
    level from the leaf through its group's root to the root; ``fold`` recomputes the root from it.

    The leaf is the hash of ``fields``, each ``-`` if null, else UTF-8 byte count, colon and value.
    A group's leaves ascend by id (null first, equal ids by leaf), groups by UTF-8 bytes (null
    first).  Every 8 consecutive nodes, the last run with fewer or one, become their hash until one
    is left; a lone leaf is its group's root, a lone group's root is the root.  Repeated rows are
    leaves of their own.  An empty table gives no rows; columns that are not named are not read.
    """
    extra = {f"carry{i}": c for i, c in enumerate((carry or {}).values())}
    leaves = docs.select(F.col(id_col).alias("doc_id"), F.col(group_col).alias("grp"),
                         row_digest([F.col(c) for c in fields]).alias("digest"),
                         *[c.alias(name) for name, c in extra.items()])
    rows = _ranked(leaves, "grp", ["doc_id", "digest"], "merkle-leaves")
    kept = ["doc_id", *extra]
    low, tops = _climb(rows, kept, "merkle")
    groups = _ranked(tops.select(F.lit("").alias("all"), F.col("grp").alias("name"),
                                 F.col("top").alias("digest")), "all", ["name"], "merkle-groups")
    high, root = _climb(groups.withColumnRenamed("all", "grp"), ["name"], "merkle-top")
    crown = root.select("grp", F.array().cast(FLANKS).alias("path"), F.col("top").alias("root"))
    known = written(_descend(high, crown, ["name"], ["root"]).select(
        F.col("name").alias("grp"), "path", "root", F.col("digest").alias("subroot")),
        "merkle-subroots")
    return _descend(low, known, kept, ["subroot", "root"]).select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", "path",
        *[F.col(c).alias(name) for c, name in zip(extra, carry or {}, strict=True)])


def verified_manifest(docs: DataFrame, fields: list[str], group_col: str = "lang",
                      id_col: str = "doc_id", text_col: str = "text", every: int = 3) -> DataFrame:
    """The manifest with each row's proof and the root recomputed from tampered rows.

    Rows whose id's crc32 (of its decimal digits) is divisible by ``every`` are tampered: A-Z of
    their text is lowered.  A null id is not tampered, a null text stays null.  ``proof_sha256`` is
    the hash of all siblings of the path; ``folded_root`` comes from the tampered row's leaf, or
    the leaf itself where nothing changed, and the original siblings.
    """
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % every == 0
    lowered = F.translate(F.col(text_col), UPPER, LOWER)
    forged = F.when(hit & (lowered != F.col(text_col)), row_digest(
        [lowered if c == text_col else F.col(c) for c in fields]))
    found = merkle_manifest(docs, fields, group_col, id_col, {"forged": forged})
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    folded = fold(F.coalesce("forged", "leaf"), F.col("path"))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"),
                        folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
