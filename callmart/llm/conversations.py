"""Conversation prefix trie: every distinct prefix of turns, with counts over what starts with it.

Turns become ids, hashes of role and text, and conversations become rows of eight positional columns of them. ROLLUP over
these columns groups all their prefixes at once, and grouping_id says how long each one is. A longer conversation continues in further
rows, each keyed by the node that the row before ends in; that node is known by sums over the hashes
of all turns up to it, so all rows of a conversation are keyed by one running sum and grouped in the same ROLLUP.

Sums over a subtree are sums over its members, which the same ROLLUP takes. Of the members of a node the smallest conversation holds it,
and what a conversation holds is the end of its path, so two numbers describe it: the depth from which it
holds nodes, and the holder one above. A node's children are the members that hold one at the next depth, its leaves those that hold
their last node if nothing goes on from there, and the tokens saved below it are the bytes that members have there without holding them.

Texts are read once, to be hashed. A conversation of very many turns is numbered and summed piece by piece, and
members of a common node are combined in each task before they are sent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmart.llm.common import batches_of
from callmart.operators.ordered import running
from callmart.session import stage

#: Positional columns of a row.
BLOCK = 8
#: Conversations are told apart by fives, and take up to eight turns of the first of their five.
FAMILY, HEADS = 5, 9
#: Bits of a conversation's id that stay together in a part of a node's list of ids.
PART_BITS = 16


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), id and bytes of each turn: ordered by turn, missing first, then by the id, a hash of role and text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.left(F.sha2(whole.cast("binary"), 256), F.lit(32)).alias("id"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    return running(rows, ["conv_id"], ["turn", "id"], sums={"pos": "1"}).drop("turn")


def head_length(conv_id: Column) -> Column:
    """How many turns a conversation takes over."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEADS).cast("int")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, n_turns, bytes) and their turns (conv_id, pos, id, bytes), rebuilt from ``turns``.

    A conversation c begins with the first h turns of conversation c - c % 5, and goes on with its own after its first h.
    """
    kept = turns.withColumn("h", head_length(F.col("conv_id")))
    sizes = kept.groupBy("conv_id", "h").agg(
        F.count_if(F.col("pos") > F.col("h")).alias("own"),
        F.coalesce(F.sum(F.when(F.col("pos") > F.col("h"), F.col("bytes"))), F.lit(0)).alias("own_bytes"),
    )
    first = turns.where((F.col("pos") < HEADS) & (F.col("conv_id") % FAMILY == 0))
    first = first.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "id", "bytes"))).alias("first"))
    sizes = sizes.withColumn("of", F.col("conv_id") - F.col("conv_id") % FAMILY)
    taken = F.coalesce(F.slice("first", F.lit(1), F.col("h")), F.expr("cast(array() as array<struct<pos: bigint, id: string, bytes: bigint>>)"))
    convs = sizes.join(first, F.col("of") == F.col("base"), "left").withColumn("head", taken)
    head_bytes = F.aggregate("head", F.lit(0).cast("long"), lambda total, t: total + t["bytes"])
    convs = stage(
        convs.select(
            "conv_id", "head", F.size("head").alias("taken"),
            (F.size("head") + F.col("own")).alias("n_turns"), (head_bytes + F.col("own_bytes")).alias("bytes"),
        ),
        "conversations",
    )
    shift = convs.select(F.col("conv_id").alias("_conv"), "taken")
    own = kept.where("pos > h").join(shift, F.col("conv_id") == F.col("_conv"))
    own = own.select("conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("pos"), "id", "bytes")
    both = convs.select("conv_id", F.inline("head")).unionByName(own)
    return convs.select("conv_id", "n_turns", "bytes"), both


def blocks(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """Rows of eight turns: conv_id, block (from 0), turns, the node before (a, b) and the bytes before.

    A conversation without turns has one row of none.
    """
    placed = turns.withColumn("block", F.expr(f"(pos - 1) div {BLOCK}"))
    mark = F.sha2(F.concat_ws(":", F.col("pos").cast("string"), "id").cast("binary"), 256)
    part = lambda at: F.conv(F.substring(mark, at, 15), 16, 10).cast("decimal(38,0)")
    rows = placed.select("conv_id", "block", "pos", "id", "bytes", part(1).alias("a"), part(16).alias("b"))
    rows = rows.groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(F.struct("pos", "id", "bytes"))).alias("turns"),
        *[F.sum(c).cast("decimal(38,0)").alias(f"own_{c}") for c in ("a", "b", "bytes")],
    )
    empty = convs.where("n_turns = 0").select(
        "conv_id", F.lit(0).cast("long").alias("block"), F.expr("cast(array() as array<struct<pos: bigint, id: string, bytes: bigint>>)").alias("turns"),
        *[F.lit(0).cast("decimal(38,0)").alias(f"own_{c}") for c in ("a", "b", "bytes")],
    )
    summed = running(rows.unionByName(empty), ["conv_id"], ["block"], sums={f"sum_{c}": f"own_{c}" for c in ("a", "b", "bytes")})
    before = lambda c, t: (F.col(f"sum_{c}") - F.col(f"own_{c}")).cast(t).alias(c)
    return summed.select(
        "conv_id", "block", before("a", "decimal(38,0)"), before("b", "decimal(38,0)"), before("bytes", "long"),
        F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["bytes"].alias("bytes"))).alias("turns"),
    )


IDS = [f"t{k}" for k in range(1, BLOCK + 1)]
#: Turns of a group's prefix within its row, from which columns ROLLUP has left in.
LEVEL = f"({BLOCK} - bit_count(grouping_id()))"


def _rolled(rows: DataFrame, measures: list[str]) -> DataFrame:
    """ROLLUP over the positional columns of ``rows``: block, a, b, the ids, level and ``measures``, for each node."""
    wide = rows.selectExpr("*", *[f"get(turns, {k - 1}).id as t{k}" for k in range(1, BLOCK + 1)])
    ids = ", ".join(IDS)
    grouped = rows.sparkSession.sql(
        f"select block, a, b, {ids}, {LEVEL} as level, {', '.join(measures)} from {{wide}} group by block, a, b, rollup({ids})",
        wide=wide,
    )
    # A turn that a group's members do not have is no node; the node before a row belongs to the row before.
    real = " or ".join(f"level = {k} and t{k} is not null" for k in range(1, BLOCK + 1))
    return grouped.where(f"{real} or level = 0 and block = 0")


def _path(ids: str) -> str:
    """A hash of the node before a row and the ``ids`` from there."""
    return f"left(sha2(concat_ws(',', block, a, b, {ids}), 256), 32)"


def _ends(ends: DataFrame) -> DataFrame:
    """node_conv, depth and the hash of the sorted, comma-joined ids of ``ends`` (conv_id, node_conv, depth).

    Ids close to each other are joined first, so a part has a bounded number of them, and the hash of a node reads part after part.
    """
    part = F.shiftright("conv_id", PART_BITS).alias("part")
    parts = ends.groupBy("node_conv", "depth", part).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, hashlib.sha256()
        for batch in batches_of(batches):
            done: list[tuple[int, int, str]] = []
            for conv, depth, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if (conv, depth) == node:
                    digest.update(b",")
                else:
                    if node:
                        done.append((*node, digest.hexdigest()))
                    node, digest = (conv, depth), hashlib.sha256()
                digest.update(ids.encode())
            yield _rows(done)
        if node:
            yield _rows([(*node, digest.hexdigest())])

    ordered = parts.repartition("node_conv", "depth").sortWithinPartitions("node_conv", "depth", "part")
    return ordered.mapInArrow(hashed, "node_conv long, depth long, ends_sha256 string")


def _rows(done: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*done, strict=True)) or [(), (), ()]
    types = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["node_conv", "depth", "ends_sha256"])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations, one row each.

    conv_id (the smallest member) and depth name a node. parent_conv_id names its parent, a depth less (root: missing);
    n_convs counts members, n_children the next turns, n_leaves the childless nodes of its subtree; saved_tokens sums, over its
    subtree, the UTF-8 bytes of a node's last text times its members but one; ends_sha256 is the hash of the members that end there.

    Missing roles and texts are empty, a missing turn number comes first, and turns of one number are ordered by the hash of
    role and text. Rows without conv_id take no part. Repeated rows are turns of their own. Conversations that
    are rebuilt without turns are members of the root. An empty table has no root. Other columns are not read.
    """
    turns = stage(turn_rows(conversations), "turns")
    convs, new = rebuilt(turns)
    rows = stage(blocks(convs, new), "blocks")

    # Who holds each node, and how far its members go.
    sized = rows.join(convs.select(F.col("conv_id").alias("_c"), "n_turns"), F.col("conv_id") == F.col("_c")).drop("_c")
    held = _rolled(sized, ["min(conv_id) as holder", "max(n_turns) as longest"]).where("level > 0")
    held = held.selectExpr(f"{_path(', '.join(IDS))} as node", "holder", "longest")
    ids, sizes = "transform(turns, t -> t.id)", "transform(turns, t -> t.bytes)"
    steps = sized.selectExpr(
        "conv_id", "block", "a", "b", "n_turns", "bytes", f"{ids} as ids", f"{sizes} as sizes", "posexplode(turns) as (k, turn)"
    ).selectExpr(
        "conv_id",
        f"{_path('array_join(slice(ids, 1, k + 1), ",")')} as node",
        f"{BLOCK} * block + k + 1 as depth",
        "n_turns",
        "bytes + aggregate(slice(sizes, 1, k), 0L, (x, y) -> x + y) as before",
    )
    at = steps.join(held, "node")
    own = "holder = conv_id"
    per = at.groupBy("conv_id").agg(
        F.expr(f"min(if({own}, depth, null)) as since"),
        F.expr(f"min_by(before, if({own}, depth, null)) as shared"),
        F.expr(f"max_by(holder, if({own}, null, depth)) as above"),
        F.expr("max(if(depth = n_turns, holder, null)) as last_holder"),
        F.expr(f"max(if(depth = n_turns and {own} and longest = depth, 1, 0)) as leaf"),
    )
    top = convs.agg(F.min("conv_id"), F.max("n_turns")).first()
    root = F.lit(top[0]).cast("long")
    per = stage(
        convs.join(per.withColumnRenamed("conv_id", "_c"), F.col("conv_id") == F.col("_c"), "left").select(
            "conv_id",
            "n_turns",
            # A copy of smaller conversations holds nothing.
            F.coalesce("since", F.col("n_turns") + 1).alias("since"),
            F.coalesce("shared", "bytes").alias("shared"),
            F.coalesce("above", root).alias("above"),
            F.coalesce("last_holder", root).alias("last_holder"),
            F.coalesce("leaf", ((F.col("conv_id") == root) & F.lit(top[1] == 0)).cast("int")).alias("leaf"),
        ),
        "holders",
    )

    wide = rows.join(per.select(F.col("conv_id").alias("_c"), "n_turns", "since", "shared", "leaf"), F.col("conv_id") == F.col("_c")).drop("_c")
    depth = lambda k: f"{BLOCK} * block + {k}"
    children = [f"count_if(since <= {depth(k)} + 1 and n_turns > {depth(k)}) as c{k}" for k in range(BLOCK + 1)]
    so_far = lambda k: f"bytes + aggregate(slice(sizes, 1, {max(0, k - 1)}), 0L, (x, y) -> x + y)"
    wide = wide.selectExpr("*", f"{sizes} as sizes").selectExpr("*", *[f"greatest(0L, shared - ({so_far(k)})) as s{k}" for k in range(BLOCK + 1)])
    saved = [f"sum(s{k}) as v{k}" for k in range(BLOCK + 1)]
    nodes = _rolled(wide.drop("sizes"), ["min(conv_id) as conv_id", "count(*) as n_convs", "sum(leaf) as n_leaves", *children, *saved])
    chosen = lambda c: "case level " + " ".join(f"when {k} then {c}{k}" for k in range(BLOCK + 1)) + " end"
    nodes = nodes.selectExpr(
        "conv_id", f"{depth('level')} as depth", "n_convs", f"{chosen('c')} as n_children", "n_leaves", f"{chosen('v')} as saved_tokens"
    )
    ends = _ends(per.select("conv_id", F.col("last_holder").alias("node_conv"), F.col("n_turns").cast("long").alias("depth")))
    ends = ends.withColumnRenamed("depth", "_depth")
    links = per.select(F.col("conv_id").alias("_c"), "since", "above")
    done = nodes.join(links, F.col("conv_id") == F.col("_c"))
    done = done.join(ends, (F.col("conv_id") == F.col("node_conv")) & (F.col("depth") == F.col("_depth")), "left")
    parent = F.when(F.col("depth") == 0, None).when(F.col("depth") > F.col("since"), F.col("conv_id")).otherwise(F.col("above"))
    return done.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        parent.cast("long").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.col("n_leaves").cast("long").alias("n_leaves"),
        F.col("saved_tokens").cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
