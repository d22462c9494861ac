"""The prefix trie of conversations, its subtree figures by the Euler-tour technique.

1. Turns are put in order by one range sort of the whole table, which gives every turn a dense position, and so every
   conversation a run of positions.  What a turn must know of its conversation meets it by (conversation, block of
   positions), so a conversation of any length is spread over tasks.
2. The sequence of a conversation's first d turns is named by d and a running XOR of hashes of (place, turn).  Equal
   names are one node.  That the name tells sequences apart is checked: the turns that meet in a node must have one
   SHA-256 and one parent, which by induction over the depth makes their sequences equal; if not, the job fails.
3. Nodes are sorted by parent and smallest member; their positions are their ids.  So a node's children have consecutive
   ids, and the tour's successors are arithmetic: into the first child or back out, to the next id or out of the parent.
4. The tour, an enter and an exit arc per node, is ranked by pointer jumping: arcs join the arcs they point to, which no
   two arcs share, so joins stay even, and their number is the logarithm of the tour's length.
5. Running sums over the ranked arcs, in blocks of positions, give what a subtree holds: the sum at a node's exit less
   the sum before its entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.llm.common import block_of, blocks, materialize, ordered
from freightlens.session import shared_dir

#: Positions that meet in one group, turns of one conversation or arcs of the tour.
BLOCK = 10_000
#: Characters of joined ids in a row on the way to their digest.
CHUNK = 1 << 16
#: Conversations that may share turns, and the most turns they share.
FAMILY, SHARED = 5, 8
_DIGEST = [f"d{i}" for i in range(4)]
_NODE = ("depth", "ka", "kb")


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, size (UTF-8 bytes of the text) and the SHA-256 of role and text as four longs."""
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    lanes = [F.conv(F.substring("digest", 16 * i + 1, 16), 16, -10).cast("long").alias(d) for i, d in enumerate(_DIGEST)]
    rows = conversations.where(conversations["conv_id"].isNotNull()).select(
        conversations["conv_id"].cast("long").alias("conv_id"), conversations["turn"].alias("turn"),
        F.octet_length(text).cast("long").alias("size"), digest.alias("digest"),
    )
    return rows.select("conv_id", "turn", "size", *lanes)


def plan(placed: DataFrame) -> DataFrame:
    """One row per conversation: where its turns start, how many (``n``), how many of them it leaves out (``h``), how many
    it takes from its family's first conversation (``given``), and who takes from it (``takers``, at most nine)."""
    whole = placed.groupBy("conv_id").agg(F.min("pos").alias("start"), F.count(F.lit(1)).alias("n"))
    whole = materialize(whole, "conversations")
    c = F.col("conv_id")
    known = whole.withColumns({"h": F.crc32(c.cast("string").cast("binary")) % (SHARED + 1), "base": c - c % FAMILY})
    source = whole.select(F.col("conv_id").alias("base"), F.col("n").alias("_m"))
    known = known.join(source, "base", "left").withColumn("given", F.least("h", F.coalesce("_m", F.lit(0))))
    known = known.withColumn("length", F.col("given") + F.greatest(F.lit(0), F.col("n") - F.col("h")))
    takers = known.groupBy("base").agg(F.collect_list(F.struct("conv_id", "h", "length")).alias("takers"))
    takers = takers.withColumnRenamed("base", "_base")
    known = known.join(takers, c == F.col("_base"), "left")
    return known.select("conv_id", "start", "n", "h", "given", "length", "takers")


def rebuilt(placed: DataFrame, known: DataFrame, block: int = BLOCK) -> DataFrame:
    """Turns of the rebuilt conversations: c, depth, size, digest, and whether it is the last."""
    runs = known.select("*", blocks("start", "n", block).alias("block")).drop("n")
    met = placed.withColumn("block", block_of("pos", block)).join(runs, ["conv_id", "block"])
    met = met.withColumn("p", F.col("pos") - F.col("start") + 1)
    p, depth = F.col("p"), F.col("given") + F.col("p") - F.col("h")
    own = F.struct(F.col("conv_id").alias("c"), depth.alias("depth"), (depth == F.col("length")).alias("last"))
    lent = F.transform(
        F.filter(F.coalesce("takers", F.array()), lambda t: p <= t["h"]),
        lambda t: F.struct(t["conv_id"].alias("c"), p.alias("depth"), (p == t["length"]).alias("last")),
    )
    every = F.concat(F.when(p > F.col("h"), F.array(own)).otherwise(F.array().cast(lent_type)), lent.cast(lent_type))
    return met.select(F.explode(every).alias("t"), "size", *_DIGEST).select("t.*", "size", *_DIGEST)


lent_type = "array<struct<c:bigint,depth:bigint,last:boolean>>"


def paths(turned: DataFrame, block: int = BLOCK) -> DataFrame:
    """The node of every rebuilt turn, (depth, ka, kb), and the node above it, (depth - 1, pa, pb); the root has zeros."""
    lanes = {x: F.xxhash64(F.lit(i), "depth", *_DIGEST) for i, x in enumerate(("xa", "xb"), 1)}
    rows = turned.withColumns(lanes).withColumn("block", block_of("depth", block))
    along = Window.partitionBy("c", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({k: F.bit_xor(x).over(along) for k, x in (("ka", "xa"), ("kb", "xb"))})
    # Conversations of several blocks bring along what stands before a block; there is a row per block.
    whole = rows.groupBy("c", "block").agg(F.bit_xor("xa").alias("ya"), F.bit_xor("xb").alias("yb"))
    before = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = whole.select("c", "block", F.bit_xor("ya").over(before).alias("ya"), F.bit_xor("yb").over(before).alias("yb"))
    joined = local.join(carried.where("ya is not null"), ["c", "block"], "left")
    for k, y in (("ka", "ya"), ("kb", "yb")):
        joined = joined.withColumn(k, F.col(k).bitwiseXOR(F.coalesce(y, F.lit(0).cast("long"))))
    above = [F.col(k).bitwiseXOR(F.col(x)).alias(p) for k, x, p in (("ka", "xa", "pa"), ("kb", "xb", "pb"))]
    return joined.select("c", "depth", "last", "size", *_DIGEST, "ka", "kb", *above)


def nodes(path: DataFrame) -> DataFrame:
    """One row per node but the root; fails if different sequences have one name."""
    same = ("pa", "pb", *_DIGEST)
    found = path.groupBy(*_NODE).agg(
        F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("size").alias("size"),
        *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"_{c}") for c in same],
    )
    one = F.lit(True)
    for c in same:
        one = one & (F.col(c) == F.col(f"_{c}"))
    checked = F.when(one, F.col("conv_id")).otherwise(F.raise_error(F.lit("two sequences of turns share a name")).cast("long"))
    return found.select(*_NODE, checked.alias("conv_id"), "n_convs", "size", "pa", "pb", (F.col("depth") - 1).alias("above"))


def linked(found: DataFrame, root: DataFrame, block: int = BLOCK) -> DataFrame:
    """Nodes with ids from 0 on (the root has -1), their parents, first children and whether they are a last child."""
    placed = ordered(found, "above", "pa", "pb", "conv_id").withColumnRenamed("pos", "id")
    families = placed.groupBy(F.col("above").alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb")).agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n_children")
    )
    every = placed.select("id", *_NODE, "conv_id", "n_convs", "size").unionByName(root)
    parents = families.join(every.select("id", *_NODE, "conv_id"), list(_NODE))
    parents = materialize(parents.select("id", *_NODE, "conv_id", "first", "n_children"), "parents")
    runs = parents.select(
        F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("depth").alias("above"),
        F.col("ka").alias("pa"), F.col("kb").alias("pb"), (F.col("first") + F.col("n_children") - 1).alias("final"),
        blocks("first", "n_children", block).alias("block"),
    )
    below = placed.withColumn("block", block_of("id", block)).join(runs, ["above", "pa", "pb", "block"])
    below = below.select(
        "id", *_NODE, "conv_id", "n_convs", "size", "parent", "parent_conv_id", (F.col("id") == F.col("final")).alias("final")
    )
    top = root.select("*", *[F.lit(None).cast("long").alias(c) for c in ("parent", "parent_conv_id")], F.lit(True).alias("final"))
    with_children = below.unionByName(top).join(parents.select("id", "first", "n_children"), "id", "left")
    return materialize(with_children.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "nodes")


def tour(tree: DataFrame) -> DataFrame:
    """(arc, next) of the Euler tour: 2 id enters a node, 2 id + 1 leaves it; the last arc leaves the root."""
    enter, leave = F.col("id") * 2, F.col("id") * 2 + 1
    down = F.when(F.col("n_children") > 0, F.col("first") * 2).otherwise(leave)
    on = F.when(F.col("final"), F.col("parent") * 2 + 1).otherwise((F.col("id") + 1) * 2)
    arcs = F.array(F.struct(enter.alias("arc"), down.alias("next")), F.struct(leave.alias("arc"), on.alias("next")))
    return tree.select(F.explode(arcs).alias("a")).select("a.*")


def ranked(arcs: DataFrame, length: int) -> DataFrame:
    """(arc, pos): the place of each of ``length`` arcs (arc, next) in their list, from 0 on, by pointer jumping.

    Arcs are numbered from -2 on.  Every round each arc learns where the arc it points to points, and how far that is.
    Rounds are checkpointed, so a lost executor costs one round at most.
    """
    shared_dir(arcs.sparkSession)
    now = arcs.withColumn("far", F.when(F.col("next").isNull(), 0).otherwise(1).cast("long"))
    # Arcs that have arrived look for an arc that there is not, each for its own, as they would share the key null.
    ahead_of = F.coalesce("next", F.lit(-10) - F.col("arc"))
    for _ in range(max(1, (length - 1).bit_length())):
        ahead = now.select(F.col("arc").alias("_at"), F.col("next").alias("_next"), F.col("far").alias("_far"))
        jumped = now.withColumn("_to", ahead_of).join(ahead, F.col("_to") == F.col("_at"), "left")
        far = F.col("far") + F.coalesce("_far", F.lit(0))
        now = jumped.select("arc", F.col("_next").alias("next"), far.alias("far")).checkpoint()
    return now.select("arc", (F.lit(length - 1) - F.col("far")).alias("pos"))


def subtree_sums(places: DataFrame, tree: DataFrame, weights: dict[str, Column], block: int = BLOCK) -> DataFrame:
    """id and, for each weight of a node, its sum over the node's subtree, from running sums over the tour."""
    weighed = tree.select("id", *[w.cast("long").alias(k) for k, w in weights.items()])
    out = F.pmod(F.col("arc"), F.lit(2)) == 1
    rows = places.select("pos", F.floor((F.col("arc") - F.pmod(F.col("arc"), F.lit(2))) / 2).alias("id"), out.alias("out"))
    rows = rows.join(weighed, "id").withColumns({k: F.when(F.col("out"), 0).otherwise(F.col(k)) for k in weights})
    rows = materialize(rows.withColumn("block", block_of("pos", block)), "tour")
    along = Window.partitionBy("block").orderBy("pos")
    # A row per block.
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("block").agg(*[F.sum(k).alias(k) for k in weights])
    totals = totals.select("block", *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"_{k}") for k in weights])
    sums = rows.select("id", "block", "out", *weights, *[F.sum(k).over(along).alias(f"run_{k}") for k in weights])
    sums = sums.join(totals, "block")
    # What stands before the entry counts against the sum at the exit.
    signed = {
        k: F.when(F.col("out"), F.col(f"run_{k}") + F.col(f"_{k}")).otherwise(F.col(k) - F.col(f"run_{k}") - F.col(f"_{k}"))
        for k in weights
    }
    return sums.select("id", *[s.alias(k) for k, s in signed.items()]).groupBy("id").agg(*[F.sum(k).alias(k) for k in weights])


def digests(ends: DataFrame) -> DataFrame:
    """Per node the SHA-256 of its ids (c), numerically ascending, comma-joined.

    Sorted ids are joined to chunks of bounded size where they lie; the chunks of a node then pass in order through one
    digest, never held together.
    """
    key = [pa.field(n, pa.int64()) for n in _NODE]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in key] + ["c", "ids"]
        node, first, ids, size = None, None, [], 0
        for batch in batches:
            done = []
            for *at, c in zip(*(batch.column(n).to_pylist() for n in (*_NODE, "c"))):
                if ids and (at != node or size >= CHUNK):
                    done.append((*node, first, ",".join(ids)))
                    ids, size = [], 0
                if not ids:
                    node, first = at, c
                ids.append(str(c))
                size += len(ids[-1]) + 1
            if done:
                yield pa.record_batch([pa.array(x) for x in zip(*done)], names=names)
        if ids:
            yield pa.record_batch([pa.array([x]) for x in (*node, first, ",".join(ids))], names=names)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*(f.name for f in key), "ends_sha256"]
        node, state = None, None
        for batch in batches:
            done = []
            for *at, ids in zip(*(batch.column(n).to_pylist() for n in (*_NODE, "ids"))):
                if at != node:
                    if state:
                        done.append((*node, state.hexdigest()))
                    node, state = at, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            if done:
                yield pa.record_batch([pa.array(x) for x in zip(*done)], names=names)
        if state:
            yield pa.record_batch([pa.array([x]) for x in (*node, state.hexdigest())], names=names)

    columns = ", ".join(f"{n} long" for n in _NODE)
    ranged = ends.select(*_NODE, "c").repartitionByRange(*_NODE, "c").sortWithinPartitions(*_NODE, "c")
    chunks = ranged.mapInArrow(join, f"{columns}, c long, ids string")
    return chunks.repartition(*_NODE).sortWithinPartitions(*_NODE, "c").mapInArrow(digest, f"{columns}, ends_sha256 string")


def conversation_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A conversation c is rebuilt from the first h = crc32(c) % 9 turns of conversation c - c % 5 and its own turns after its
    first h.  Turns are ordered by ``turn``, null first; of rows with the same turn the digests of role and text decide,
    and repeated rows are turns of their own.  A null role or text is empty, rows without conv_id are left out.  The root
    has depth 0 and every conversation as a member.  An empty table has no root and gives an empty result.
    """
    spark = conversations.sparkSession
    placed = ordered(turns(conversations), "conv_id", "turn", *_DIGEST)
    known = materialize(plan(placed), "plan")
    all_of = known.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).first()
    if not all_of.n_convs:
        schema = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
        return spark.createDataFrame([], f"{schema}, ends_sha256 string")
    path = materialize(paths(materialize(rebuilt(placed, known, block), "rebuilt"), block), "paths")
    top = "id long, depth long, ka long, kb long, conv_id long, n_convs long, size long"
    root = spark.createDataFrame([(-1, 0, 0, 0, all_of.conv_id, all_of.n_convs, 0)], top)
    tree = linked(nodes(path), root, block)
    places = ranked(tour(tree), 2 * tree.count())
    leaf, saved = F.when(F.col("n_children") == 0, 1).otherwise(0), (F.col("n_convs") - 1) * F.col("size")
    sums = subtree_sums(places, tree, {"n_leaves": leaf, "saved_tokens": saved}, block)
    zero = F.lit(0).cast("long")
    turnless = known.where("length = 0").select(*[zero.alias(n) for n in _NODE], F.col("conv_id").alias("c"))
    ends = digests(path.where("last").select(*_NODE, "c").unionByName(turnless))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return tree.join(sums, "id").join(ends, list(_NODE), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
