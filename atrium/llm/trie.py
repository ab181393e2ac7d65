"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

Turns become digests, and a prefix is known by the exclusive-or of the hashes of its (place, digest) pairs,
128 bits wide: a running value that blocks of one conversation can compute apart, so that a conversation of
any length is dealt over many tasks. Nodes are one row per distinct prefix. Their totals come from rounds of
joins on node ids: leaves are raked into their parents, every other node of a unary chain is spliced out, and
when only the root is left the spliced nodes are put back, last round first, each with its child's total.
The number of rounds grows with the logarithm of the depth, not with the depth.

Rows without a conv_id belong to no conversation and are left out. Null roles and texts are empty, turns are
ordered with nulls first, then by role and text digest; repeated rows are turns of their own. Other columns of
the input are not read, whatever their names. No conversations give no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atrium.llm.common import WORD, broadcast_if_small, materialize

#: A node's sorted members travel in strings of so many ids at most.
CHUNK_IDS = 4_096


def words_in(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, digest, words) of each row: its place from 1 in its conversation, a digest of role and text, the words of the text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        role.alias("role"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        words_in(text).alias("words"),
        # Equal rows may be many; a number lets them be dealt over several ranges.
        (F.monotonically_increasing_id() % 997).alias("mark"),
    )
    return scan(materialize(rows, "turns"), "conv_id", ("turn", "role", "digest", "mark")).select("conv_id", F.col("place").alias("at"), "digest", "words")


def scan(rows: DataFrame, group: str, order: tuple[str, ...], folds: tuple[str, ...] = ()) -> DataFrame:
    """rows with `place`, the place from 1 in the group (nulls first), and each column of `folds` (long) xor-ed over the group's rows so far.

    Rows are sorted into ranges of (group, order) and scanned range by range; what a range must add for the
    group that began before it is worked out from one row per range, so a hot group is no single task's.
    """
    names = [*rows.columns, "part", "place"]
    schema = T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType())])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count, carried = TaskContext.get().partitionId(), None, 0, {f: np.int64(0) for f in folds}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(group).to_numpy(zero_copy_only=False)
            new = np.r_[True, keys[1:] != keys[:-1]]
            begin = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            goes_on = (begin == 0) & (keys[0] == last)
            at = np.arange(n) - begin + 1 + np.where(goes_on, count, 0)
            columns = dict(zip(batch.schema.names, batch.columns))
            for f in folds:
                run = np.bitwise_xor.accumulate(columns[f].to_numpy(zero_copy_only=False))
                run = run ^ np.where(begin > 0, run[begin - 1], 0) ^ np.where(goes_on, carried[f], 0)
                carried[f] = run[-1]
                columns[f] = pa.array(run, pa.int64())
            last, count = keys[-1], at[-1]
            yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(np.full(n, part, np.int32)), pa.array(at, pa.int64())], names=names)

    ordering = [F.col(group), *(F.col(c).asc_nulls_first() for c in order)]
    found = materialize(rows.repartitionByRange(*ordering).sortWithinPartitions(*ordering).mapInArrow(local, schema), "scan")
    ends = found.groupBy("part").agg(F.min(group).alias("first"), F.max(F.struct(group, "place", *folds)).alias("last")).orderBy("part").collect()
    offsets, open_group, state = [], None, (0, *(0 for _ in folds))
    for row in ends:
        key, *values = row["last"]
        if row["first"] == open_group:
            offsets.append((row["part"], open_group, *state))
        if key == open_group:  # the range holds nothing but the open group
            state = (state[0] + values[0], *(a ^ b for a, b in zip(state[1:], values[1:])))
        else:
            open_group, state = key, tuple(values)
    # One row per range at most, so its size is bounded by the number of ranges.
    added = F.broadcast(rows.sparkSession.createDataFrame(offsets, ", ".join(["part_ int", "group_ long", "place_ long", *(f"{f}_ long" for f in folds)])))
    joined = found.join(added, (F.col("part") == F.col("part_")) & (F.col(group) == F.col("group_")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    kept = [F.col(c).bitwiseXOR(zero(f"{c}_")).alias(c) if c in folds else F.col(c) for c in rows.columns]
    return joined.select(*kept, (F.col("place") + zero("place_")).alias("place"))


def prefixes(turns: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """(conv_id, depth, id, parent, words) of each turn's prefix; turns are (conv_id, *order, digest, words)."""
    numbered = scan(turns, "conv_id", order).select("conv_id", F.col("place").alias("depth"), "digest", "words")
    hashed = numbered.select("conv_id", "depth", "words", F.xxhash64("depth", "digest").alias("a"), F.xxhash64(F.lit("b"), "digest", "depth").alias("b"), F.xxhash64("depth", "digest").alias("own_a"), F.xxhash64(F.lit("b"), "digest", "depth").alias("own_b"))
    run = scan(materialize(hashed, "hashed"), "conv_id", ("depth",), ("a", "b"))
    before = F.struct(F.col("a").bitwiseXOR(F.col("own_a")).alias("a"), F.col("b").bitwiseXOR(F.col("own_b")).alias("b"))
    return run.select("conv_id", "depth", F.struct("a", "b").alias("id"), before.alias("parent"), "words")


def root_id() -> Column:
    """The root's id: the prefix of no turns."""
    return F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))


def rake(live: DataFrame, coin) -> DataFrame:
    """live with state `raked` (leaves, whose totals are final), `spliced` (nodes of one child, chosen by coin) or `stays`.

    Leaves are added to their parents before; `kids` counts the children left. A spliced node's coin is 1 and
    its only child's 0, so that no two neighbours are spliced at once.
    """
    leaf = F.col("kids") == 0
    sent = live.where("parent IS NOT NULL").groupBy(F.col("parent").alias("to")).agg(
        F.sum(F.when(leaf, F.col("leaves")).otherwise(0)).alias("more_leaves"),
        F.sum(F.when(leaf, F.col("saved")).otherwise(0)).alias("more_saved"),
        F.sum(F.when(leaf, 0).otherwise(1)).alias("left"),
        F.min(F.when(~leaf, F.struct("id", "depth"))).alias("next"),
    )
    left = F.coalesce("left", F.lit(0))
    alone = F.col("parent").isNotNull() & (left == 1) & (coin(F.col("id"), F.col("depth")) == 1) & (coin(F.col("next.id"), F.col("next.depth")) == 0)
    return live.join(sent, F.col("id") == F.col("to"), "left").select(
        "id",
        "parent",
        "depth",
        left.alias("kids"),
        (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
        (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        F.col("next.id").alias("child"),
        F.when(leaf, "raked").when(alone, "spliced").otherwise("stays").alias("state"),
    )


def compress(raked: DataFrame) -> DataFrame:
    """The nodes that stay: a spliced node's child hangs on its parent, which takes over what the spliced node holds."""
    gone = raked.where("state = 'spliced'")
    none, zero = F.lit(None).cast(raked.schema["parent"].dataType), F.lit(0).cast("long")
    to_child = gone.select(F.col("child").alias("to"), F.col("parent").alias("up"), zero.alias("l"), zero.alias("s"))
    to_parent = gone.select(F.col("parent").alias("to"), none.alias("up"), F.col("leaves").alias("l"), F.col("saved").alias("s"))
    sent = to_child.union(to_parent).groupBy("to").agg(F.max("up").alias("up"), F.sum("l").alias("l"), F.sum("s").alias("s"))
    return raked.where("state = 'stays'").join(sent, F.col("id") == F.col("to"), "left").select(
        "id", F.coalesce("up", "parent").alias("parent"), "depth", "kids", (F.col("leaves") + F.coalesce("l", zero)).alias("leaves"), (F.col("saved") + F.coalesce("s", zero)).alias("saved")
    )


def contract(nodes: DataFrame) -> list[DataFrame]:
    """The written rounds of rake and compress, until only the root is left and raked.

    nodes: (id, parent, depth, kids, leaves, saved), the last two of the node itself; the root's parent is null.
    A round's coin is a bit of the depth, so that an untouched chain is halved each round; beyond the bits that
    depths have it is a hash of id and round, which also halves what chains later rakes have left.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    live, rounds = nodes, []
    while True:
        r = len(rounds)
        bits = r < int(deepest).bit_length()
        coin = (lambda id_, depth, r=r: F.shiftright(depth, r).bitwiseAND(1)) if bits else (lambda id_, depth, r=r: F.xxhash64(id_, F.lit(r)).bitwiseAND(1))
        rounds.append(materialize(rake(live, coin), f"rake-{r}"))
        if rounds[-1].where("state <> 'raked'").isEmpty():
            return rounds
        live = materialize(compress(rounds[-1]), f"compress-{r}")


def expand(rounds: list[DataFrame]) -> DataFrame:
    """(id, leaves, saved) of every node: raked nodes as they are, spliced ones with their child's total, last round first."""
    known = None
    for r, rows in reversed(list(enumerate(rounds))):
        done = rows.where("state = 'raked'").select("id", "leaves", "saved")
        if known is not None:
            below = known.select(F.col("id").alias("child"), F.col("leaves").alias("l"), F.col("saved").alias("s"))
            spliced = rows.where("state = 'spliced'").join(below, "child")
            done = done.union(materialize(spliced.select("id", (F.col("leaves") + F.col("l")).alias("leaves"), (F.col("saved") + F.col("s")).alias("saved")), f"expand-{r}"))
        known = done if known is None else known.union(done)
    return known


def digests(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256) of nodes at which members end; ends are (id, conv_id).

    Members are sorted in ranges and joined to strings of at most CHUNK_IDS ids; a node's strings are hashed in
    order as they stream by, so that a node with very many members needs no list of them.
    """
    flat = ends.select("id.a", "id.b", "conv_id")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held = None, []

        def out(rows):
            return pa.RecordBatch.from_pydict({"a": [r[0] for r in rows], "b": [r[1] for r in rows], "first": pa.array([r[2] for r in rows], pa.int64()), "ids": [r[3] for r in rows]})

        for batch in batches:
            rows = []
            for a, b, c in zip(*(batch.column(x).to_pylist() for x in ("a", "b", "conv_id"))):
                if held and ((a, b) != node or len(held) >= CHUNK_IDS):
                    rows.append((*node, held[0], ",".join(map(str, held))))
                    held = []
                node = (a, b)
                held.append(c)
            if rows:
                yield out(rows)
        if held:
            yield out([(*node, held[0], ",".join(map(str, held)))])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            rows = []
            for a, b, ids in zip(*(batch.column(x).to_pylist() for x in ("a", "b", "ids"))):
                if (a, b) == node:
                    state.update(b"," + ids.encode())
                else:
                    if node:
                        rows.append((*node, state.hexdigest()))
                    node, state = (a, b), hashlib.sha256(ids.encode())
            if rows:
                yield pa.RecordBatch.from_pydict({k: [r[i] for r in rows] for i, k in enumerate(("a", "b", "ends_sha256"))})
        if node:
            yield pa.RecordBatch.from_pydict({"a": [node[0]], "b": [node[1]], "ends_sha256": [state.hexdigest()]})

    strings = flat.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id").mapInArrow(chunks, "a long, b long, first long, ids string")
    hashed = strings.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(hashes, "a long, b long, ends_sha256 string")
    return hashed.select(F.struct("a", "b").alias("id"), "ends_sha256")


def prefix_trie(turns: DataFrame, members: DataFrame, order: tuple[str, ...] = ("at",)) -> DataFrame:
    """One row per node of the trie of the members' turns.

    turns are (conv_id, *order, digest, words), members (conv_id) all conversations, also those without turns.
    Returns conv_id (the smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves
    and saved_tokens of the subtree, ends_sha256 (members that end here, ascending).
    """
    paths = materialize(prefixes(turns, order), "prefixes")
    members = materialize(members.select("conv_id").distinct(), "members")
    own = paths.groupBy("id").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("parent").alias("parent"), F.max("depth").alias("depth"), F.max("words").alias("words"))
    zero = F.lit(0).cast("long")
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(root_id().alias("id"), "conv_id", "n_convs", F.lit(None).cast(paths.schema["parent"].dataType).alias("parent"), zero.alias("depth"), zero.alias("words"))
    every = materialize(own.unionByName(root), "nodes")
    kids = every.where("parent IS NOT NULL").groupBy(F.col("parent").alias("to")).agg(F.count("*").alias("kids"))
    nodes = materialize(every.join(kids, F.col("id") == F.col("to"), "left").withColumn("kids", F.coalesce("kids", zero)).drop("to"), "nodes")
    weights = nodes.select("id", "parent", "depth", "kids", (F.col("kids") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    totals = expand(contract(weights))
    last = paths.groupBy("conv_id").agg(F.max(F.struct("depth", "id")).alias("end")).select("conv_id", F.col("end.id").alias("id"))
    bare = members.join(last, "conv_id", "left_anti").select("conv_id", root_id().alias("id"))
    ends = digests(materialize(last.unionByName(bare), "ends"))
    # Many nodes may hang on one parent: parents are broadcast if few by count, and else the join is left to
    # adaptive execution, which can split a parent of very many children.
    parents = materialize(nodes.where("kids > 0").select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parents")
    whole = nodes.join(broadcast_if_small(parents), "parent", "left")
    out = whole.join(totals, "id", "left").join(ends, "id", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
