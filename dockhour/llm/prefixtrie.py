"""Trie of conversation prefixes, built as a z-fast trie and expanded to one row a prefix.

A conversation is a string of turns.  The trie is kept compacted: a node has the depth of its
extent, the depth of its parent (``top``) and a conversation that runs through it.  Its handle is
its extent cut at the two-fattest number of (top, depth], the one with the most trailing zeros, and
nodes are found by the hash of their handle.  A fat binary search looks up one prefix a step, so a
conversation finds the node where it leaves the trie in about log2(turns) joins.

Conversations are inserted in batches: all that still lack a place search at once, each new branch
takes one of those that leave there, and the others search on below it.

Nothing is gathered by conversation: prefixes are rows (conversation, depth) under a hash that is a
running sum over turns, so one very long conversation spreads over partitions.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, written
from .prefix import running

ROOT = ""
LANES = ["lane0", "lane1", "lane2", "lane3"]
RUN_BYTES = 1 << 16
PIECE = 4096


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, place, key, chars): turns from 0, null turns first, ties by role and text.

    ``key`` is a hash of role and text, null being empty; rows without a ``conv_id`` belong to no
    conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
              .cast("binary")).alias("key"), F.length(text).cast("long").alias("chars"))
    return written(running(turns, ["conv_id"], ["turn", "key"], [], "trie-turns").select(
        "conv_id", F.col("row_before").alias("place"), "key", "chars"), "trie-numbered")


def borrowed_heads(turns: DataFrame, block: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that start like the first of their block: (turns by depth, all conv_ids).

    Conversation c takes the first h = crc32(c) % ``most`` turns of conversation c - c % ``block``
    (all if it has fewer, none if it does not exist), then its own after its first h.
    """
    own_id = F.col("conv_id")
    convs = written(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "n", (own_id - own_id % block).alias("base"),
        (F.crc32(own_id.cast("string").cast("binary")) % most).alias("h")), "trie-conversations")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = written(convs.join(bases, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")),
        "trie-heads")
    heads = turns.filter(F.col("place") < most - 1).select(
        F.col("conv_id").alias("_base"), "place", "key", "chars")
    borrowed = convs.join(heads, (F.col("base") == F.col("_base")) & (F.col("place") < F.col("h")))
    own = turns.join(convs, "conv_id").filter("place >= h")
    return borrowed.select("conv_id", (F.col("place") + 1).alias("depth"), "key", "chars").unionByName(
        own.select("conv_id", (F.col("place") - F.col("h") + F.col("taken") + 1).alias("depth"),
                   "key", "chars")), convs.select("conv_id")


def _prefixes(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, depth, print, chars, upto): hash and code points of each prefix.

    The hash of a prefix comes from four running sums of hashes of (turn, depth).
    """
    x, y = F.xxhash64("key", "depth"), F.xxhash64("depth", F.lit("z"), "key")
    low, high = (lambda v: v.bitwiseAND(0xFFFFFFFF)), (lambda v: F.shiftrightunsigned(v, 32))
    lanes = [part(v).alias(n) for n, (v, part) in zip(
        LANES, [(x, low), (x, high), (y, low), (y, high)], strict=True)]
    summed = running(turns.select("conv_id", "depth", "chars", *lanes), ["conv_id"], ["depth"],
                     [*LANES, "chars"], "trie-sums")
    sums = [(F.col(n) + F.col(f"{n}_before")).cast("string") for n in LANES]
    return written(summed.select(
        "conv_id", "depth", F.md5(F.concat_ws(",", F.col("depth").cast("string"), *sums)
                                  .cast("binary")).alias("print"), "chars",
        (F.col("chars") + F.col("chars_before")).alias("upto")), "trie-prefixes")


def _two_fattest(low: str, high: str) -> Column:
    """The number in (low, high] with the most trailing zeros."""
    b = f"length(bin({low} ^ {high})) - 1"
    return F.expr(f"shiftleft(shiftright({high}, {b}), {b})")


def _at(rows: DataFrame, paths: DataFrame, depth: Column, name: str, how: str = "left") -> DataFrame:
    """Add the prefix of ``rep`` at ``depth`` as ``name``; the root's where depth is 0.

    Where nothing is found, ``name`` is null.  Depths below 0 stand for no question.
    """
    p = paths.select(F.col("rep").alias("_rep"), F.col("depth").alias("_depth"),
                     F.col("print").alias("_print"))
    keyed = rows.withColumn("_ask", depth)
    out = keyed.join(p, (F.col("rep") == F.col("_rep")) & (F.col("_ask") == F.col("_depth")), how)
    return out.withColumn(name, F.when(F.col("_ask") == 0, F.lit(ROOT)).otherwise(
        F.col("_print"))).drop("_ask", "_rep", "_depth", "_print")


def _locate(pending: DataFrame, nodes: DataFrame, paths: DataFrame, steps: int,
            label: str) -> DataFrame:
    """Where each pending conversation (rep, n, low, node) leaves the trie.

    Gives (rep, n, lcp, edge, edge_depth): how deep it follows the trie, and the node on whose edge
    that lies; ``edge`` is null where it leaves right at a node.
    """
    handles = nodes.select(F.col("handle").alias("_handle"), F.col("handle_print").alias("_hp"),
                           F.col("node").alias("_hit"), F.col("depth").alias("_hit_depth"))
    state = pending.select("rep", "n", "low", F.col("n").alias("high"), "node",
                           F.col("low").alias("sure"))
    for _ in range(steps):
        # Conversations that are done ask for a depth that no prefix has, each for its own.
        asked = state.withColumn("f", F.when(F.col("low") < F.col("high"), _two_fattest("low", "high"))
                                 .otherwise(F.lit(-1).cast("long")))
        asked = _at(asked, paths, F.col("f"), "probe").withColumn(
            "probe", F.coalesce("probe", F.col("rep").cast("string")))
        found = asked.join(handles, (F.col("f") == F.col("_handle")) & (F.col("probe") == F.col("_hp")),
                           "left")
        hit = F.col("_hit").isNotNull()
        state = found.select(
            "rep", "n", F.when(hit, F.col("_hit_depth")).otherwise(F.col("low")).alias("low"),
            F.when(hit | (F.col("f") < 0), F.col("high")).otherwise(F.col("f") - 1).alias("high"),
            F.when(hit, F.col("_hit")).otherwise(F.col("node")).alias("node"),
            F.when(hit, F.col("f")).otherwise(F.col("sure")).alias("sure"))
    state = written(state.drop("high"), f"{label}-found")

    # The node's handle is a prefix; where its whole extent is, the exit is on the edge below.
    known = _at(_at(state, paths, F.col("low"), "reached"), paths, F.when(
        F.col("low") < F.col("n"), F.col("low") + 1).otherwise(F.lit(-1).cast("long")), "step")
    known = known.withColumn("through", F.coalesce(F.col("reached") == F.col("node"), F.lit(False)))
    edges = nodes.select(F.col("node").alias("edge"), F.col("depth").alias("edge_depth"),
                         F.col("rep").alias("other"))
    below = nodes.select(F.col("first").alias("step"), F.col("node").alias("edge"),
                         F.col("depth").alias("edge_depth"), F.col("rep").alias("other"))
    at_node = known.filter("through").withColumn(
        "step", F.coalesce("step", F.concat(F.lit("end"), F.col("rep").cast("string"))))
    on = written(known.filter("NOT through").join(edges, F.col("node") == F.col("edge")).select(
        "rep", "n", F.col("sure").alias("low"), "edge", "edge_depth", "other").unionByName(
        at_node.join(below, "step", "left").select(
            "rep", "n", "low", "edge", "edge_depth", "other")), f"{label}-edges")

    # How far the edge is followed: prefixes that equal those of the edge's conversation.
    own = on.filter("edge IS NOT NULL").join(paths, "rep").filter(
        (F.col("depth") > F.col("low")) & (F.col("depth") <= F.least("n", "edge_depth")))
    o = paths.select(F.col("rep").alias("other"), "depth", "print")
    same = own.select("rep", "other", "depth", "print").join(o, ["other", "depth", "print"]).groupBy(
        "rep").agg(F.count(F.lit(1)).alias("more"))
    return written(on.join(same, "rep", "left").select(
        "rep", "n", (F.col("low") + F.coalesce("more", F.lit(0))).alias("lcp"), "edge", "edge_depth"),
        f"{label}-exits")


def _placed(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes (node, depth, top, up, rep) with their first step and handle."""
    out = _at(nodes, paths, F.col("top") + 1, "first")
    out = out.withColumn("handle", _two_fattest("top", "depth"))
    return _at(out, paths, F.col("handle"), "handle_print")


def _insert(exits: DataFrame, nodes: DataFrame | None, paths: DataFrame, batch: int):
    """The trie with a batch inserted, and the conversations that wait below its new leaves."""
    label = f"trie{batch}"
    placed = _at(_at(exits, paths, F.col("lcp"), "place"), paths, F.when(
        F.col("lcp") < F.col("n"), F.col("lcp") + 1).otherwise(F.lit(-1).cast("long")), "step")
    placed = written(placed, f"{label}-places")
    chosen = placed.filter("lcp < n").groupBy("step").agg(
        F.min_by("rep", F.struct(F.xxhash64("rep", F.lit(batch)), "rep")).alias("rep"))
    chosen = written(chosen.select("rep", F.lit(True).alias("chosen")), f"{label}-chosen")
    waiting = placed.join(chosen, "rep", "left")
    leaves = _at(waiting.filter("chosen").select(
        "rep", F.col("n").alias("depth"), F.col("lcp").alias("top"), F.col("place").alias("up")),
        paths, F.col("depth"), "node")
    new = leaves
    if nodes is not None:
        cuts = placed.filter("edge IS NOT NULL AND lcp < edge_depth").groupBy(
            F.col("edge"), F.col("lcp").alias("depth")).agg(F.min("place").alias("node"))
        cuts = written(cuts, f"{label}-cuts")
        cut = cuts.select(F.col("edge").alias("node")).distinct()
        split = nodes.join(cut, "node", "left_semi")
        ends = split.select(F.col("node").alias("edge"), F.col("top").alias("_top"),
                            F.col("up").alias("_up"), "rep")
        points = cuts.join(ends, "edge").unionByName(split.select(
            F.col("node").alias("edge"), "depth", "node", F.col("top").alias("_top"),
            F.col("up").alias("_up"), "rep"))
        ahead = "OVER (PARTITION BY edge ORDER BY depth)"
        pieces = points.select(
            "rep", "depth", F.expr(f"coalesce(lag(depth) {ahead}, _top)").alias("top"),
            F.expr(f"coalesce(lag(node) {ahead}, _up)").alias("up"), "node")
        new = leaves.unionByName(pieces.select(*leaves.columns))
    grown = _placed(new, paths)
    if nodes is not None:
        grown = nodes.join(cut, "node", "left_anti").select(*grown.columns).unionByName(grown)
    grown = written(grown, f"{label}-nodes")
    rest = written(waiting.filter("lcp < n AND chosen IS NULL").select(
        "rep", "n", F.col("lcp").alias("low"), F.col("place").alias("node")), f"{label}-rest")
    return grown, rest


def z_fast_trie(paths: DataFrame, ends: DataFrame) -> DataFrame:
    """The compacted trie of different conversations.

    ``paths`` has (rep, depth, print), ``ends`` (rep, n) with n > 0.  Rows (node, depth, top, up,
    rep, first, handle, handle_print): ``node`` is the hash of the extent, ``up`` the parent's.
    """
    longest = ends.agg(F.max("n")).first()[0] or 0
    none = F.lit(None)
    exits = ends.select("rep", "n", F.lit(0).cast("long").alias("lcp"),
                        none.cast("string").alias("edge"), none.cast("long").alias("edge_depth"))
    nodes, rest = _insert(exits, None, paths, 0)
    batch = 0
    while not rest.isEmpty():
        batch += 1
        exits = _locate(rest, nodes, paths, longest.bit_length(), f"trie{batch}")
        nodes, rest = _insert(exits, nodes, paths, batch)
    return nodes


def _lines_of_descent(nodes: DataFrame) -> list[DataFrame]:
    """Each node's ancestor at distance 1, 2, 4 and so on, where that is not the root."""
    line = written(nodes.filter(F.col("up") != ROOT).select("node", F.col("up").alias("above")),
                   "trie-above0")
    out = []
    while not line.isEmpty():
        out.append(line)
        far = line.select(F.col("node").alias("above"), F.col("above").alias("far"))
        line = written(line.join(far, "above").select("node", F.col("far").alias("above")),
                       f"trie-above{len(out)}")
    return out


def _over_subtrees(rows: DataFrame, lines: list[DataFrame], aggs: dict, label: str) -> DataFrame:
    """``rows`` by node with each column of ``aggs`` (sum or min) taken over the node's subtree.

    Step i adds what the descendants at distance 2 ** i hold of theirs nearer than that.
    """
    for i, line in enumerate(lines):
        more = rows.join(line, "node").groupBy(F.col("above").alias("node")).agg(
            *[how(c).alias(f"_{c}") for c, how in aggs.items()])
        both = rows.join(more, "node", "left")
        rows = written(both.select("node", *[
            (F.least(c, f"_{c}") if how is F.min else F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c)
            for c, how in aggs.items()]), f"{label}{i}")
    return rows


def _join_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (print, conv_id) to runs of ids as text of bounded size."""
    for b in batches:
        out: list[tuple[str, int, list[bytes]]] = []
        held = 0
        for p, c in zip(b["print"].to_pylist(), b["conv_id"].to_pylist(), strict=True):
            if not out or out[-1][0] != p or held > RUN_BYTES:
                out.append((p, c, []))
                held = 0
            out[-1][2].append(b"%d" % c)
            held += 20
        yield pa.record_batch([pa.array([x[0] for x in out], pa.string()),
                               pa.array([x[1] for x in out], pa.int64()),
                               pa.array([b",".join(x[2]) for x in out], pa.binary())],
                              names=["print", "first", "ids"])


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs to one digest a print, streamed: no group is held."""
    last, digest = None, None
    for b in batches:
        done = []
        for p, ids in zip(b["print"].to_pylist(), b["ids"].to_pylist(), strict=True):
            if p != last:
                if digest is not None:
                    done.append((last, digest.hexdigest()))
                last, digest = p, hashlib.sha256(ids)
            else:
                digest.update(b"," + ids)
        yield pa.record_batch([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)],
                              names=["node", "ends_sha256"])
    if digest is not None:
        yield pa.record_batch([pa.array([last]), pa.array([digest.hexdigest()])],
                              names=["node", "ends_sha256"])


def _end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids, joined by commas, that share an end.

    Ids are dealt by range, so a hot end spreads; runs of them meet in one task, some thousand ids
    a row, because the digest is sequential.
    """
    runs = ends.select("print", "conv_id").repartitionByRange("print", "conv_id").sortWithinPartitions(
        "print", "conv_id").mapInArrow(_join_runs, "print string, first long, ids binary")
    return runs.repartition("print").sortWithinPartitions("print", "first").mapInArrow(
        _hash_runs, "node string, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations, the empty one (depth 0) included.

    ``turns`` has (conv_id, depth from 1 without gaps, key, chars), ``convs`` every conv_id once,
    those without turns too.  A prefix's members are the conversations that start with it.  Columns:
    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (the parent's ``conv_id``, null for
    the root), ``n_convs`` (members), ``n_children``, ``n_leaves`` (prefixes without children in the
    subtree), ``saved_tokens`` (over the subtree: n_convs - 1 times the last turn's chars) and
    ``ends_sha256`` (of the comma-joined ascending ids of members that end here).

    Equal conversations are inserted once.  No conversations, no rows.
    """
    ship(turns.sparkSession)
    prefixes = _prefixes(turns)
    last = prefixes.groupBy("conv_id").agg(F.max("depth").alias("n"),
                                           F.max_by("print", "depth").alias("print"))
    ends = written(convs.join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("n", F.lit(0).cast("long")).alias("n"),
        F.coalesce("print", F.lit(ROOT)).alias("print")), "trie-ends")
    classes = written(ends.groupBy("print", "n").agg(
        F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "trie-classes")
    several = classes.filter("n > 0").select("rep")
    paths = written(prefixes.withColumnRenamed("conv_id", "rep").join(several, "rep", "left_semi"),
                    "trie-paths")
    nodes = z_fast_trie(paths, classes.filter("n > 0").select("rep", "n"))
    digests = written(_end_digests(ends), "trie-digests")

    here = classes.select(F.col("print").alias("node"), "copies", F.col("rep").alias("least"))
    children = nodes.groupBy(F.col("up").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    known = written(nodes.select("node", "depth", "top", "up", "rep").join(here, "node", "left")
                    .join(children, "node", "left").select(
        "node", "depth", "top", "up", "rep", "least", F.coalesce("copies", F.lit(0)).alias("copies"),
        F.coalesce("n_children", F.lit(0)).alias("n_children")), "trie-known")
    lines = _lines_of_descent(known)
    counted = _over_subtrees(known.select(
        "node", F.col("copies").alias("n_convs"), F.col("least").alias("conv_id"),
        (F.col("n_children") == 0).cast("long").alias("n_leaves")), lines,
        {"n_convs": F.sum, "conv_id": F.min, "n_leaves": F.sum}, "trie-counts")

    chars = paths.select("rep", "depth", "upto")
    top = chars.select("rep", F.col("depth").alias("top"), F.col("upto").alias("_ahead"))
    sized = written(known.join(counted, "node").join(chars, ["rep", "depth"]).join(
        top, ["rep", "top"], "left").withColumn(
        "own", (F.col("n_convs") - 1) * (F.col("upto") - F.coalesce("_ahead", F.lit(0)))).drop(
        "_ahead"), "trie-sized")
    saved = _over_subtrees(sized.select("node", F.col("own").alias("saved")), lines,
                           {"saved": F.sum}, "trie-saved")

    everything = ends.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                          F.lit(ROOT).alias("node"))
    firsts = sized.agg(
        F.coalesce(F.sum((F.col("up") == ROOT).cast("long")), F.lit(0)).alias("n_children"),
        F.coalesce(F.sum((F.col("n_children") == 0).cast("long")), F.lit(0)).alias("leaves"),
        F.coalesce(F.sum("own"), F.lit(0)).alias("saved_tokens"))
    nobody = hashlib.sha256(b"").hexdigest()
    end_here = F.coalesce("ends_sha256", F.lit(nobody))
    root = everything.filter("n_convs > 0").crossJoin(firsts).join(  # one row each
        digests.filter(F.col("node") == ROOT), "node", "left").select(
        "conv_id", F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
        F.greatest("leaves", F.lit(1)).alias("n_leaves"), "saved_tokens",
        end_here.alias("ends_sha256"))

    least = everything.select("node", "conv_id").unionByName(counted.select("node", "conv_id"))
    parents = least.select(F.col("node").alias("up"), F.col("conv_id").alias("up_conv_id"))
    full = sized.join(saved, "node").join(parents, "up").join(digests, "node", "left").select(
        "rep", F.col("depth").alias("bottom"), "top", "conv_id", "up_conv_id", "n_convs", "n_children",
        "n_leaves", (F.col("saved") - F.col("own")).alias("below"), F.col("upto").alias("bottom_upto"),
        end_here.alias("ends_sha256"))
    # An edge becomes its prefixes; long ones in pieces, so that no row holds all its depths.
    pieces = full.withColumn("start", F.explode(F.sequence(
        F.col("top") + 1, F.col("bottom"), F.lit(PIECE).cast("long"))))
    edges = pieces.withColumn("depth", F.explode(F.sequence(
        "start", F.least("bottom", F.col("start") + (PIECE - 1)))))
    end = F.col("depth") == F.col("bottom")
    return edges.join(paths.select("rep", "depth", "chars", "upto"), ["rep", "depth"]).select(
        "conv_id", "depth",
        F.when(F.col("depth") == F.col("top") + 1, F.col("up_conv_id")).otherwise(F.col("conv_id"))
        .alias("parent_conv_id"), "n_convs",
        F.when(end, F.col("n_children")).otherwise(1).cast("long").alias("n_children"), "n_leaves",
        (F.col("below") + (F.col("n_convs") - 1) * (
            F.col("bottom_upto") - F.col("upto") + F.col("chars"))).alias("saved_tokens"),
        F.when(end, F.col("ends_sha256")).otherwise(nobody).alias("ends_sha256")).unionByName(root)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """``prefix_trie`` of conversations (conv_id, turn, role, text) with borrowed heads.

    Turns are ordered by ``turn`` (null first), ties by a hash of role and text; null role or text
    is empty; repeated rows are turns of their own.  Rows without a ``conv_id`` are left out: they
    belong to no conversation.  An empty table gives no rows; other columns are not read.
    """
    return prefix_trie(*borrowed_heads(numbered_turns(conversations)))
