"""The trie of conversation prefixes, by vertical bitmaps in shards.

Texts are read once: a turn becomes two 64-bit hashes of role and text and a number of words.
Conversations are dealt by ranges of (conversation, place of the turn) to shards of about
`SHARD_ROWS` turns each, so a conversation of any length spreads over as many shards as it
needs. What a shard must know of a conversation that began before it, its depth and the hash
of its path, is summed up for the conversations at the edges of shards, two for each shard
at most.

A node is named by its depth and the xor of the hashes of its turns with their positions. A
shard indexes (position, turn) to bitsets of its conversations, `BITS` at a time, and
goes depth first: a node's bitset is intersected with the bitsets of the turns that follow
in it, which gives the children; bits are counted, the lowest one is the smallest member, and
the members that end there are listed. Spark merges the nodes of the shards by name. Sums over
subtrees need no walk up the trie: what a node adds is put on the path of its smallest member,
every path is summed up from its end, and a node gets the sums of its members at its depth.

Defined cases: rows without conv_id are left out; a null turn comes first, equal turns go by
the hash of role and text; a null role or text is empty. Repeated rows are turns of their own.
Other columns are not read. An empty table gives no row. Turns and paths are told apart by 128
bits of hash. The end list of a node is hashed in order as a stream, in one task with one
batch at a time in memory: the digest asks for that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmeter.llm.common import written

SHARD_ROWS = 1 << 17
BITS = 2048
FAMILY = 20
HEADS = 3
WORD = r"[^\x20\x09-\x0D]+"
ITSELF, HEAD, OWN = 0, 1, 2
NODE = ["depth", "n1", "n2"]
EDGE = ["conv_id", "shard"]
PARTS = "depth int, n1 long, n2 long, p1 long, p2 long, conv_id long, n_convs long, words long, shard int, part int, ends string"
SUMS = "depth int, n1 long, n2 long, saved long, leaves long"
SHA = "depth int, n1 long, n2 long, ends_sha256 string"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def own_after(conv_id="conv_id"):
    """How many turns a conversation takes from the first of its family."""
    return F.crc32(F.col(conv_id).cast("string")) % (HEADS + 1)


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, k1, k2, words of every turn, and a number that tells equal ones apart."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("k1"),
        F.xxhash64(text, role, F.lit(1)).alias("k2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("row"),
    )


def _with_heads(own: DataFrame) -> DataFrame:
    """A row for every conversation, then those it takes over, then its own, by kind."""
    order = [F.col("turn").asc_nulls_first(), "k1", "k2", "row"]
    first = (
        own.where(f"pmod(conv_id, {FAMILY}) = 0")
        .withColumn("place", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)))
        .where(f"place <= {HEADS}")  # limited before the shuffle, however long a conversation is
        .select(F.col("conv_id").alias("family"), "place", "k1", "k2", "words")
    )
    convs = own.select("conv_id").distinct()
    family = F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))
    heads = convs.withColumn("family", family).join(first, "family").where(F.col("place") <= own_after())
    none = [F.lit(0).cast("long").alias(c) for c in ("turn", "k1", "k2", "words", "row")]
    return (
        convs.select("conv_id", F.lit(ITSELF).alias("kind"), *none)
        .unionByName(heads.select("conv_id", F.lit(HEAD).alias("kind"), F.col("place").cast("long").alias("turn"), "k1", "k2", "words", F.lit(0).cast("long").alias("row")))
        .unionByName(own.withColumn("kind", F.lit(OWN)))
    )


def _sharded(rows: DataFrame, n: int) -> DataFrame:
    order = ["conv_id", "kind", F.col("turn").asc_nulls_first(), "k1", "k2", "row"]
    return rows.repartitionByRange(n, *order).withColumn("shard", F.spark_partition_id())


def _at_edges(rows: DataFrame) -> DataFrame:
    """The rows of conversations that are the first or last of a shard."""
    edges = rows.groupBy("shard").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high"))
    edges = edges.select(F.explode(F.array("low", "high")).alias("conv_id")).distinct()
    return rows.join(edges, "conv_id", "left_semi")


def rebuilt(shards: DataFrame) -> DataFrame:
    """conv_id, shard, depth, z1, z2, words, is_end of the rebuilt turns; depth 0 is the conversation."""
    earlier = Window.partitionBy("conv_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    counts = [F.count_if(F.col("kind") == kind).alias(name) for kind, name in ((HEAD, "heads"), (OWN, "own"))]
    edges = (
        _at_edges(shards)
        .groupBy(*EDGE)
        .agg(*counts)
        .select(
            *EDGE,
            *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("heads", "own")),
            *(F.sum(c).over(whole).alias(f"{c}_all") for c in ("heads", "own")),
        )
    )
    inside = Window.partitionBy(*EDGE)
    place = F.row_number().over(Window.partitionBy(*EDGE, "kind").orderBy(F.col("turn").asc_nulls_first(), "k1", "k2", "row"))
    rows = shards.withColumns({"place": place.cast("long")} | {n: F.count_if(F.col("kind") == k).over(inside) for k, n in ((HEAD, "heads"), (OWN, "own"))})
    rows = rows.join(edges, EDGE, "left").withColumn("h", own_after())
    heads, own = (F.coalesce(f"{c}_all", c) for c in ("heads", "own"))
    numbered = rows.withColumns(
        {
            "own_place": F.coalesce("own_before", F.lit(0)) + F.col("place"),
            "length": heads + F.greatest(own - F.col("h"), F.lit(0)),
            "depth": F.when(F.col("kind") == ITSELF, F.lit(0))
            .when(F.col("kind") == HEAD, F.coalesce("heads_before", F.lit(0)) + F.col("place"))
            .otherwise(heads + F.coalesce("own_before", F.lit(0)) + F.col("place") - F.col("h")),
        }
    ).where(f"kind <> {OWN} or own_place > h")
    depth, top = F.col("depth").cast("int"), F.col("kind") == ITSELF
    return numbered.select(
        *EDGE,
        depth.alias("depth"),
        F.when(top, F.lit(0)).otherwise(F.xxhash64(depth, "k1", "k2")).cast("long").alias("z1"),
        F.when(top, F.lit(0)).otherwise(F.xxhash64("k2", depth, "k1")).cast("long").alias("z2"),
        "words",
        (F.col("depth") == F.col("length")).alias("is_end"),
    )


def _carried(rows: DataFrame) -> DataFrame:
    """For shards in which a conversation goes on: its depth and path so far."""
    earlier = Window.partitionBy("conv_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    parts = _at_edges(rows).groupBy(*EDGE).agg(F.max("depth").alias("depth"), F.bit_xor("z1").alias("z1"), F.bit_xor("z2").alias("z2"))
    before = parts.select(*EDGE, F.max("depth").over(earlier).alias("depth"), *(F.bit_xor(z).over(earlier).alias(z) for z in ("z1", "z2")))
    return before.where("depth is not null")


def _runs(conv: np.ndarray) -> np.ndarray:
    """Where conversations begin, and the end."""
    return np.concatenate([np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]])), [len(conv)]]) if len(conv) else np.zeros(1, np.int64)


def _paths(z: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The xor of a conversation's values up to each row."""
    whole = np.bitwise_xor.accumulate(z)
    before = np.concatenate([[0], whole])[bounds[:-1]]
    return whole ^ np.repeat(before, np.diff(bounds))


class Bitmaps:
    """Postings of some conversations, and the walk through their common prefixes.

    Rows are in order of conversation and depth. The first row of a conversation is its depth 0,
    or the carried path of one that began in an earlier shard.
    """

    def __init__(self, depth: np.ndarray, z1: np.ndarray, z2: np.ndarray, bounds: np.ndarray):
        self.depth, self.bounds = depth, bounds
        keys: dict[tuple[int, int, int], int] = {}
        self.posting = [keys.setdefault(k, len(keys)) for k in zip(depth.tolist(), z1.tolist(), z2.tolist(), strict=True)]
        self.bits = [0] * len(keys)
        for conv, (low, high) in enumerate(zip(bounds.tolist(), bounds[1:].tolist(), strict=False)):
            bit = 1 << conv
            for k in self.posting[low:high]:
                self.bits[k] |= bit

    def walk(self) -> Iterator[tuple[int, int, int]]:
        """A row of the node's smallest member, the node's bitset, and the row of the parent or -1; depth first."""
        starts = self.bounds.tolist()
        longer: dict[int, int] = {}  # conversations that have a row so far behind their first
        for conv, (low, high) in enumerate(zip(starts, starts[1:], strict=False)):
            for k in range(high - low):
                longer[k] = longer.get(k, 0) | 1 << conv
        stack, rest = [], (1 << len(starts) - 1) - 1
        while rest:
            conv = (rest & -rest).bit_length() - 1
            top = rest & self.bits[self.posting[starts[conv]]]
            stack.append((starts[conv], top, -1, 0))
            rest ^= top
        while stack:
            row, members, parent, below = stack.pop()
            yield row, members, parent
            rest, below = members & longer.get(below + 1, 0), below + 1
            while rest:
                nearest = starts[(rest & -rest).bit_length() - 1] + below
                child = rest & self.bits[self.posting[nearest]]
                stack.append((nearest, child, row, below))
                rest ^= child


def _listed(members: int) -> list[int]:
    """The bits that are set."""
    data = np.frombuffer(members.to_bytes((members.bit_length() + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(data, bitorder="little")).tolist()


def _ordered(shard: pa.Table) -> dict[str, np.ndarray]:
    table = shard.sort_by([("conv_id", "ascending"), ("depth", "ascending")])
    return {c: table[c].to_numpy() for c in table.column_names}


def _nodes(shard: pa.Table) -> pa.Table:
    """The nodes of a shard, with the conversations that end in them."""
    x = _ordered(shard)
    bounds = _runs(x["conv_id"])
    paths = [_paths(x[z], bounds) for z in ("z1", "z2")]
    rows, parents, sizes, parts, ends = [], [], [], [], []
    for part, first in enumerate(range(0, len(bounds) - 1, BITS)):
        own = bounds[first : first + BITS + 1]
        low, high = int(own[0]), int(own[-1])
        last = own[1:] - 1
        ended: dict[tuple[int, int, int], int] = {}
        for conv, row in enumerate(last.tolist()):
            if x["is_end"][row]:
                name = (int(x["depth"][row]), int(paths[0][row]), int(paths[1][row]))
                ended[name] = ended.get(name, 0) | 1 << conv
        ids = x["conv_id"][last].tolist()
        position = np.where(x["carried"], -1 - x["depth"], x["depth"])  # a carried path is no turn
        maps = Bitmaps(position[low:high], x["z1"][low:high], x["z2"][low:high], own - low)
        for row, members, parent in maps.walk():
            row += low
            if x["carried"][row]:
                continue
            rows.append(row)
            parents.append(parent + low if parent >= 0 else -1)
            sizes.append(members.bit_count())
            parts.append(part)
            here = members & ended.get((int(x["depth"][row]), int(paths[0][row]), int(paths[1][row])), 0)
            ends.append(",".join(str(ids[k]) for k in _listed(here)) if here else None)
    rows, parents = np.array(rows, np.int64), np.array(parents, np.int64)
    up = [np.where(parents >= 0, p[parents], 0) if len(p) else p for p in paths]
    return pa.table(
        [
            pa.array(x["depth"][rows], pa.int32()),
            *(pa.array(p[rows], pa.int64()) for p in paths),
            *(pa.array(p, pa.int64()) for p in up),
            pa.array(x["conv_id"][rows], pa.int64()),
            pa.array(sizes, pa.int64()),
            pa.array(x["words"][rows], pa.int64()),
            pa.array(x["shard"][rows], pa.int32()),
            pa.array(parts, pa.int32()),
            pa.array(ends, pa.string()),
        ],
        names=[c.split()[0] for c in PARTS.split(", ")],
    )


def _path_sums(shard: pa.Table) -> pa.Table:
    """What the paths of a shard add to each of their nodes."""
    x = _ordered(shard)
    bounds = _runs(x["conv_id"])
    table = {"depth": x["depth"]} | {n: _paths(x[z], bounds) for n, z in (("n1", "z1"), ("n2", "z2"))}
    for name in ("saved", "leaves"):
        upto = np.concatenate([[0], np.cumsum(x[name])])
        table[name] = np.repeat(upto[bounds[1:]], np.diff(bounds)) - upto[:-1]
    rows = pa.table(table).filter(pa.array(~x["carried"] & (x["depth"] >= 0)))
    summed = rows.group_by(NODE, use_threads=False).aggregate([("saved", "sum"), ("leaves", "sum")])
    return summed.select([*NODE, "saved_sum", "leaves_sum"]).rename_columns([*NODE, "saved", "leaves"])


def _end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash for each node, from its lists in order."""
    node, digest, out = None, None, []
    for batch in batches:
        for *name, ends in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ends")), strict=True):
            if name == node:
                digest.update(b",")
            else:
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = name, hashlib.sha256()
            digest.update(ends.encode())
        yield _hash_batch(out)
        out = []
    if node:
        yield _hash_batch([(*node, digest.hexdigest())])


def _hash_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*NODE, "ends_sha256"])


def _in_shards(rows: DataFrame, carried: DataFrame, *also: str) -> DataFrame:
    """Rows and carried paths, a group for each shard."""
    columns = [*EDGE, "depth", "z1", "z2", *also]
    none = [c for c in also if c not in carried.columns]
    start = carried.select(*[F.lit(0).cast(rows.schema[c].dataType).alias(c) if c in none else c for c in columns], F.lit(True).alias("carried"))
    return rows.select(*columns, F.lit(False).alias("carried")).unionByName(start).groupBy("shard")


def nodes(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    spark = conversations.sparkSession
    own = written(turns(conversations), "turns")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(own.count() / SHARD_ROWS))
    shards = written(_sharded(_with_heads(own), n), "conversation-shards")
    rows = written(rebuilt(shards), "rebuilt-turns")
    carried = written(_carried(rows), "carried-paths")

    parts = written(_in_shards(rows, carried, "words", "is_end").applyInArrow(_nodes, PARTS), "shard-nodes")
    same = [F.any_value(c).alias(c) for c in ("p1", "p2", "words")]
    merged = parts.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), *same)
    merged = written(merged, "prefix-nodes")
    up = merged.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("n1"), F.col("p2").alias("n2"))
    children = written(up.agg(F.count(F.lit(1)).alias("n_children")), "children")

    # What a node adds lies on the path of its smallest member.
    adds = merged.join(children.hint("merge"), NODE, "left").select(
        "conv_id", "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), F.col("n_children").isNull().cast("long").alias("leaves")
    )
    adds = adds.where("saved > 0 or leaves > 0")
    zero = F.lit(0).cast("long")
    weighed = rows.join(adds.hint("merge"), ["conv_id", "depth"], "left").withColumns({c: F.coalesce(c, zero) for c in ("saved", "leaves")})
    weighed = written(weighed, "weighed-turns")
    later = Window.partitionBy("conv_id").orderBy("shard").rowsBetween(1, Window.unboundedFollowing)
    tails = _at_edges(weighed).groupBy(*EDGE).agg(F.max("depth").alias("depth"), F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    tails = tails.select(*EDGE, (F.col("depth") + 1).alias("depth"), *(F.sum(c).over(later).alias(c) for c in ("saved", "leaves")))
    tails = tails.where("saved is not null").withColumns({"z1": zero, "z2": zero})
    edges = carried.withColumns({"saved": zero, "leaves": zero}).unionByName(tails)
    sums = _in_shards(weighed, edges, "saved", "leaves").applyInArrow(_path_sums, SUMS)

    # In a part, the conversation that began in an earlier shard comes before the others.
    lists = parts.where("ends is not null").select(*NODE, "shard", "part", "conv_id", "ends")
    ends = lists.repartition(*NODE).sortWithinPartitions(*NODE, "shard", "part", "conv_id").mapInArrow(_end_hashes, SHA)

    facts = ["conv_id", "p1", "p2", "n_convs"]
    numbers = (
        merged.select(*NODE, *facts)
        .unionByName(children, allowMissingColumns=True)
        .unionByName(sums.groupBy(*NODE).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves")), allowMissingColumns=True)
        .unionByName(ends, allowMissingColumns=True)
        .groupBy(*NODE)
        .agg(*(F.max(c).alias(c) for c in [*facts, "n_children", "saved_tokens", "n_leaves", "ends_sha256"]))
    )
    above = merged.select((F.col("depth") + 1).alias("below"), F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    named = numbers.withColumn("below", F.when(F.col("depth") > 0, F.col("depth"))).join(above.hint("merge"), ["below", "p1", "p2"], "left")
    return named.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )
