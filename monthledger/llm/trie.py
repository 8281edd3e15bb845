"""Prefix trie of conversations, rolled up by centroid decomposition.

A node of depth d is a distinct sequence of d turns; its members are the
conversations that start with it. Nodes are found by running hashes of 128
bits: turns are digested where they are read (SHA-256), so no text is shuffled,
and a node is named by its smallest member and its depth.

Sums over subtrees come from a centroid decomposition of the forest of parent
edges. A component is known by its top. A node weighs as many units as it has
members, so the weight of its subtree is the sum, over its members, of their
turns from that depth on: known for every node by one grouping. In a component
the nodes whose subtrees hold half its weight or more are a chain from the top
down; the lowest is the centroid. What the component holds from the centroid
down is added to every node of that chain, the centroid is taken out, and the
parts, each of half the weight at most, are split in turn: after log2 of all
turns every node has been a centroid and holds its subtree's sums.

Components above ``LOCAL`` nodes are split by joins, one round for all of them;
smaller ones are dealt out whole and split in a task. A node's ancestors are
looked up in the table of paths (conversation, depth, node), never walked.

The joined ids of the conversations that end in a node are hashed as a stream:
ranges of (node, id) write chunks of text, the chunks of a node are fed to one
hash in order. So copies of one conversation are never gathered.

Cases: null role or text is empty; turns of one number are ordered by the
digest of role and text, a null number first; repeated rows are turns of their
own; rows without conv_id belong to no conversation; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from monthledger.llm.common import arrow_batches, materialize, ship, table

ship(__name__)

#: Nodes of a component that one task may split in memory.
LOCAL = 50_000
#: Bytes of joined ids that one row of the end lists holds.
CHUNK = 1_000_000


def turn_digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, digest, chars): the turns in order, from 0, without texts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    slim = conversations.where("conv_id is not null").select("conv_id", "turn", digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return slim.withColumn("at", F.row_number().over(order).cast("long") - 1).drop("turn")


def rebuilt(turns: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Turns with the first h of conversation c - c % every in place of c's
    first h (h = crc32(c) % most), and a row with ``at`` null per conversation.
    A base has at most 2 * every conversations, so its turns meet few rows."""
    sizes = turns.groupBy("conv_id").agg((F.max("at") + 1).alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % every
    members = sizes.select("conv_id", "n", base.alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"))
    bases = sizes.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    members = members.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0)))).drop("base_n")
    heads = turns.where((F.col("conv_id") % every == 0) & (F.col("at") < most - 1)).withColumnRenamed("conv_id", "base")
    given = heads.join(members.select("base", "conv_id", "h"), "base").where("at < h").select("conv_id", "at", "digest", "chars")
    own = turns.join(members.select("conv_id", "h", "taken"), "conv_id").where("at >= h")
    own = own.select("conv_id", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "digest", "chars")
    return given.unionByName(own).unionByName(sizes.select("conv_id", F.lit(None).cast("long").alias("at"), F.lit(None).cast("string").alias("digest"), F.lit(0).cast("long").alias("chars")))


def paths_of(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, x, y, chars, total): x, y name the node at that depth of
    the conversation (the running exclusive-or of its turns' hashes with their
    place); ``total`` is the conversation's number of turns. Depth 0: the root."""
    run = Window.partitionBy("conv_id").orderBy(F.col("at").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    mark = lambda k: F.when(F.col("at").isNull(), F.lit(0)).otherwise(F.xxhash64(F.lit(k), "at", "digest"))
    return turns.select(
        "conv_id",
        F.coalesce(F.col("at") + 1, F.lit(0)).alias("depth"),
        F.bit_xor(mark(1)).over(run).alias("x"),
        F.bit_xor(mark(2)).over(run).alias("y"),
        "chars",
        (F.count(F.lit(1)).over(Window.partitionBy("conv_id")) - 1).alias("total"),
    )


def nodes_of(paths: DataFrame) -> DataFrame:
    """Nodes by (depth, x, y): conv_id (smallest member), n_convs, weight of the
    subtree (its members' turns from here on) and chars of the last text."""
    return paths.groupBy("depth", "x", "y").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("total") - F.col("depth") + 1).alias("weight"),
        F.max("chars").alias("chars"),
    )


def _ancestry(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """(member, depth, node, above, below): the smallest members of the nodes at
    a depth of a conversation's path, one higher and one lower. Only paths of
    conversations that name a node are kept; copies of another are not."""
    named = nodes.groupBy("conv_id").agg(F.max("depth").alias("low"))
    ids = nodes.select("depth", "x", "y", F.col("conv_id").alias("node"), "n_convs", "weight", F.col("chars").alias("node_chars"))
    step = Window.partitionBy("member").orderBy("depth")
    rows = paths.join(named, "conv_id").select(F.col("conv_id").alias("member"), "depth", "x", "y").join(ids, ["depth", "x", "y"])
    return rows.select(
        "member", "depth", "x", "y", "node", "n_convs", "weight", "node_chars",
        F.lag("node").over(step).alias("above"), F.lead("node").over(step).alias("below"),
    )


# ------------------------------------------------- centroid decomposition --


def split_locally(parent, weight, values):
    """Sums of ``values`` (rows of a component, tops first) over each subtree.

    ``parent`` holds row numbers, -1 for the top. Components wait on a stack;
    each gives up its centroid.
    """
    n = len(parent)
    kids: list[list[int]] = [[] for _ in range(n)]
    for i in range(n):
        if parent[i] >= 0:
            kids[parent[i]].append(i)
    weight, total = list(weight), np.zeros_like(values)
    stack = [i for i in range(n) if parent[i] < 0]
    while stack:
        top = stack.pop()
        chain, half = [top], weight[top]
        while (low := next((k for k in kids[chain[-1]] if 2 * weight[k] >= half), None)) is not None:
            chain.append(low)
        z = chain[-1]
        held, at = [z], 0
        while at < len(held):
            held.extend(kids[held[at]])
            at += 1
        total[chain] += values[held].sum(axis=0)
        stack.extend(kids[z])
        kids[z] = []
        if z != top:
            for v in chain[:-1]:
                weight[v] -= weight[z]
            kids[chain[-2]].remove(z)
            stack.append(top)
    return total


def _finish(state: DataFrame, sums: list[str]) -> DataFrame:
    """Components that fit a task, split there."""
    schema = pa.schema([(n, pa.int64()) for n in ["conv_id", "depth", *sums]])
    fields = ["top_id", "top_depth", "conv_id", "depth", "above", "weight", *sums, *[f"got_{s}" for s in sums]]

    def sums_of(rows):
        """Rows (node, sums) of one component; tops come first."""
        rows, k = list(rows), len(sums)
        number = {r[2:4]: i for i, r in enumerate(rows)}
        parent = [-1 if r[2:4] == r[:2] else number[r[4], r[3] - 1] for r in rows]
        values = np.array([r[6 : 6 + k] for r in rows], np.int64)
        total = split_locally(parent, [r[5] for r in rows], values) + np.array([r[6 + k :] for r in rows], np.int64)
        for r, t in zip(rows, total.tolist()):
            yield *r[2:4], *t

    def run(batches):
        every = itertools.chain.from_iterable(zip(*(b.column(f).to_pylist() for f in fields)) for b in batches)
        parts = itertools.groupby(every, key=lambda r: r[:2])
        return arrow_batches(itertools.chain.from_iterable(sums_of(part) for _, part in parts), schema)

    dealt = state.repartition("top_id", "top_depth").sortWithinPartitions("top_id", "top_depth", "depth", "conv_id")
    return dealt.mapInArrow(run, from_arrow_schema(schema))


def subtree_sums(nodes: DataFrame, ancestry: DataFrame, sums: list[str], local: int = LOCAL) -> DataFrame:
    """(conv_id, depth, sums): each of the columns ``sums`` over whole subtrees.

    ``nodes``: conv_id, depth, above (parent's conv_id, null at the top),
    weight of the subtree and the columns; ``ancestry`` as ``_ancestry`` gives
    it. Rounds: at most log2 of the root's weight, fewer as components fit.
    """
    comp = ["top_id", "top_depth"]
    state = nodes.select("conv_id", "depth", "above", "weight", *sums, *[F.lit(0).cast("long").alias(f"got_{s}") for s in sums])
    root = nodes.where("above is null").select("conv_id").first()
    if root is None:
        return state.select("conv_id", "depth", *sums)
    state = state.withColumns({"top_id": F.lit(root[0]).cast("long"), "top_depth": F.lit(0).cast("long")})
    done = []
    lookup = ancestry.select(F.col("member").alias("conv_id"), F.col("depth").alias("_z_depth"), F.col("node").alias("_at"), F.col("below").alias("_next"))
    while True:
        state = materialize(state, "trie")
        size = state.groupBy(*comp).agg(F.count(F.lit(1)).alias("_n"), F.max("weight").alias("_all"))
        large = size.where(F.col("_n") > local)
        if large.limit(1).count() == 0:
            break
        small = state.join(large, comp, "left_anti")
        done.append(materialize(_finish(small, sums), "trie"))
        rows = state.join(large.drop("_n"), comp).withColumn("_heavy", 2 * F.col("weight") >= F.col("_all"))
        low = F.struct("weight", -F.col("depth"), "conv_id", "depth")
        z = rows.where("_heavy").groupBy(*comp).agg(F.min(low).alias("_z"))
        z = z.select(*comp, F.col("_z.conv_id").alias("_z_id"), F.col("_z.depth").alias("_z_depth"), F.col("_z.weight").alias("_z_weight"))
        rows = rows.join(z, comp).join(lookup, ["conv_id", "_z_depth"], "left")
        under = (F.col("depth") >= F.col("_z_depth")) & (F.col("_at") == F.col("_z_id"))
        rows = rows.withColumn("_under", F.coalesce(under, F.lit(False)))
        rows = materialize(rows, "trie")
        held = rows.where("_under").groupBy(*comp).agg(*[F.sum(s).alias(f"_held_{s}") for s in sums])
        rows = rows.join(held, comp)
        is_z = (F.col("conv_id") == F.col("_z_id")) & (F.col("depth") == F.col("_z_depth"))
        got = {f"got_{s}": F.col(f"got_{s}") + F.when(F.col("_heavy"), F.col(f"_held_{s}")).otherwise(0) for s in sums}
        rows = rows.withColumns(got).withColumn("_is_z", is_z)
        done.append(rows.where("_is_z").select("conv_id", "depth", *[F.col(f"got_{s}").alias(s) for s in sums]))
        kept = rows.where("not _is_z")
        moved = {
            "weight": F.when(F.col("_heavy"), F.col("weight") - F.col("_z_weight")).otherwise(F.col("weight")),
            "top_id": F.when(F.col("_under"), F.col("_next")).otherwise(F.col("top_id")),
            "top_depth": F.when(F.col("_under"), F.col("_z_depth") + 1).otherwise(F.col("top_depth")),
        }
        state = kept.withColumns(moved).select(*state.columns)
    out = _finish(state, sums)
    for d in done:
        out = out.unionByName(d)
    return out


# ---------------------------------------------------------------- end lists --


def joined_hashes(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, ends_sha256: SHA-256 of the values of a key in order, joined by
    commas. Ranges of (keys, value) make chunks; a hash is fed chunk by chunk."""
    key_fields = [(k, pa.int64()) for k in keys]
    part_schema = pa.schema([*key_fields, ("first", pa.int64()), ("part", pa.string())])
    end_schema = pa.schema([*key_fields, ("ends_sha256", pa.string())])

    def rows_in(batches, *names):
        for b in batches:
            yield from zip(*(b.column(n).to_pylist() for n in names))

    def chunks(batches):
        key, first, parts, size = None, None, [], 0
        for *k, v in rows_in(batches, *keys, value):
            if parts and (k != key or size >= CHUNK):
                yield *key, first, ",".join(parts)
                parts, size = [], 0
            if not parts:
                key, first = k, v
            parts.append(str(v))
            size += len(parts[-1]) + 1
        if parts:
            yield *key, first, ",".join(parts)

    def digests(batches):
        key, h = None, None
        for *k, part in rows_in(batches, *keys, "part"):
            if k == key:
                h.update(b",")
            else:
                if key is not None:
                    yield *key, h.hexdigest()
                key, h = k, hashlib.sha256()
            h.update(part.encode())
        if key is not None:
            yield *key, h.hexdigest()

    parted = rows.repartitionByRange(*keys, value).sortWithinPartitions(*keys, value)
    parts = parted.select(*keys, value).mapInArrow(lambda b: arrow_batches(chunks(b), part_schema), from_arrow_schema(part_schema))
    dealt = parts.repartition(*keys).sortWithinPartitions(*keys, "first")
    return dealt.mapInArrow(lambda b: arrow_batches(digests(b), end_schema), from_arrow_schema(end_schema))


def trie(turns: DataFrame, local: int = LOCAL) -> DataFrame:
    """Nodes of the trie of conversations given as ``turn_digests`` or
    ``rebuilt`` give them (a row with ``at`` null per conversation)."""
    paths = materialize(paths_of(turns), "trie")
    nodes = materialize(nodes_of(paths), "trie")
    ancestry = materialize(_ancestry(paths, nodes), "trie")
    own = ancestry.where("member = node").select("depth", "x", "y", F.col("node").alias("conv_id"), F.col("above"), "n_convs", "weight", F.col("node_chars").alias("chars"))
    children = own.where("above is not null").groupBy(F.col("above").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    own = own.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    own = own.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("chars")})
    own = materialize(own, "trie")
    sums = subtree_sums(own, ancestry, ["n_leaves", "saved_tokens"], local)
    ends = joined_hashes(paths.where("depth = total").select("depth", "x", "y", "conv_id"), ["depth", "x", "y"], "conv_id")
    out = own.drop("n_leaves", "saved_tokens").join(sums, ["conv_id", "depth"]).join(ends, ["depth", "x", "y"], "left")
    return out.select(
        "conv_id", "depth", F.col("above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def op11(spark, sf_dir: str) -> DataFrame:
    turns = materialize(turn_digests(table(spark, sf_dir, "conversations")), "turns")
    return trie(rebuilt(turns))


SQL = r"""
with recursive bits(b, v, k) as (
  select cast(range as int), cast(range as ubigint), 0 from range(256)
  union all
  select b, case when v & 1 = 1 then xor(v >> 1, 3988292384::ubigint) else v >> 1 end, k + 1 from bits where k < 8
),
steps as (select list(v order by b) as tab from bits where k = 8),
own as (
  select conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} order by turn nulls first,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as s
  from conversations where conv_id is not null group by conv_id
),
heads as (
  select conv_id, s, conv_id - conv_id % 100 as base,
    cast(xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(range(1, length(cast(conv_id as varchar)) + 1),
      lambda i: cast(ascii(substr(cast(conv_id as varchar), i, 1)) as ubigint))),
      lambda c, d: xor(c >> 8, tab[cast(xor(c & 255, d) as int) + 1])), 4294967295::ubigint) % 6 as int) as h
  from own, steps
),
convs as (
  select a.conv_id as c, list_concat(coalesce(b.s, [])[1:a.h], a.s[a.h + 1:]) as s
  from heads a left join own b on b.conv_id = a.base
),
starts as (
  select c, s, unnest(range(len(s) + 1)) as depth, len(s) as n from convs
),
members as (select c, depth, n, s[1:depth] as node, s[1:depth - 1] as up from starts),
nodes as (
  select node, depth, any_value(up) as up, min(c) as conv_id, count(*) as n_convs,
    coalesce(string_agg(cast(c as varchar), ',' order by c) filter (n = depth), '') as ends
  from members group by node, depth
),
kids as (select up, depth, count(*) as n from nodes where depth > 0 group by up, depth),
full_nodes as (
  select x.*, coalesce(k.n, 0) as n_children, p.conv_id as parent_conv_id,
    (x.n_convs - 1) * (case when x.depth = 0 then 0 else length(x.node[x.depth].t) end) as saved
  from nodes x left join kids k on k.up = x.node and k.depth = x.depth + 1
    left join nodes p on p.node = x.up and p.depth = x.depth - 1 and x.depth > 0
),
sums as (
  select node[1:e] as node, e as depth, sum(if(n_children = 0, 1, 0)) as n_leaves, sum(saved) as saved_tokens
  from (select *, unnest(range(depth + 1)) as e from full_nodes) group by 1, 2
)
select f.conv_id, cast(f.depth as bigint) as depth, f.parent_conv_id, f.n_convs, cast(f.n_children as bigint) as n_children,
  cast(n_leaves as bigint) as n_leaves, cast(saved_tokens as bigint) as saved_tokens, sha256(ends) as ends_sha256
from full_nodes f join sums using (node, depth)
"""
