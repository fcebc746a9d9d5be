"""Merkle manifest of a dataset with incremental witnesses.

A tree takes its leaves by appending. Each open subtree holds the nodes appended to it and,
for every run of leaves below them, a partial witness: the siblings met so far on the way
up. When a run of ``ARITY`` nodes is complete, its hash is appended one level higher and
every witness below is extended by the siblings of its node. All leaves of a run share
their witness above the run, so it is held once for each run.

Spark deals the leaves of a tree in aligned blocks, ``ARITY ** HEIGHT`` leaves each, and
every task appends whole blocks as a stream. The roots of the blocks are appends to the
next tree, dealt in blocks the same way, until one node is left. So no task holds more than
a block, and the number of rounds is the logarithm of the leaves to the base 4096.

Digests are SHA-256. A parent's hash is that of its children's digests as lowercase hex.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import bound_batches, stored

ARITY = 16
# Levels of a block.
HEIGHT = 3
BLOCK = ARITY**HEIGHT
# Runs of leaves in one Arrow batch.
BATCH_RUNS = 512

Witness = list[tuple[int, bytes]]
WITNESS = "array<struct<place:int,siblings:binary>>"


def parent_of(children: list[bytes]) -> bytes:
    return sha256(b"".join(children).hex().encode()).digest()


class Appender:
    """Appends the leaves of one block; afterwards ``close`` gives its root and witnesses.

    ``levels[i]`` is the open subtree of level ``i``: its nodes so far, each with the
    witnesses of the runs of leaves below it, which grow in place.
    """

    def __init__(self):
        self.levels: list[list[tuple[bytes, list[Witness]]]] = [[]]
        self.witnesses: list[Witness] = []

    def append(self, digest: bytes) -> None:
        self.add(0, digest, [])

    def add(self, level: int, digest: bytes, below: list[Witness]) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append((digest, below))
        if len(self.levels[level]) == ARITY:
            self.complete(level)

    def complete(self, level: int) -> None:
        """Close the open run of a level: extend the witnesses below, append its hash."""
        nodes, self.levels[level] = self.levels[level], []
        digests = [digest for digest, _ in nodes]
        if level == 0:
            below: list[Witness] = [[]]
            self.witnesses += below
        else:
            below = []
            for place, (_, witnesses) in enumerate(nodes):
                step = (place, b"".join(digests[:place] + digests[place + 1 :]))
                for witness in witnesses:
                    witness.append(step)
                below += witnesses
        self.add(level + 1, parent_of(digests), below)

    def close(self, height: int | None) -> tuple[bytes, list[Witness]]:
        """The block's root and the witness of each run of leaves.

        With ``height`` the block is part of a larger tree and reaches exactly that level;
        without, it ends at the level where a single node is left.
        """
        level = 0
        while level != height and (height is not None or len(self.levels[level]) > 1 or any(self.levels[level + 1 :])):
            if self.levels[level]:
                self.complete(level)
            level += 1
        if not self.witnesses:  # a lone leaf is its own root
            self.witnesses.append([])
        return self.levels[level][0][0], self.witnesses


def appended(nodes: DataFrame) -> DataFrame:
    """Append the nodes of every tree, block by block.

    ``nodes`` has ``tree, pos, n, digest, row``: the tree, the node's place in it, how many
    nodes the tree has, and anything to carry along. One row for each run of nodes comes out:
    ``tree, block, n`` (blocks of the tree), ``run, digests, rows, witness`` and, with the
    block's first run, its ``root``. ``run`` is NULL where the node is the whole tree.
    """
    carried = nodes.schema["row"].dataType
    dealt = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK)).repartition("tree", "block")
    dealt = dealt.sortWithinPartitions("tree", "block", "pos").select("tree", "block", "n", "digest", "row")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in range(7)]
        offsets, parts = [0], []
        key, size, digests, held, kind = None, 0, [], [], None

        def close():
            tree = Appender()
            for digest in digests:
                tree.append(digest)
            root, witnesses = tree.close(HEIGHT if size > BLOCK else None)
            for i, witness in enumerate(witnesses):
                own = digests[i * ARITY : (i + 1) * ARITY]
                values = (*key, -(-size // BLOCK), i if size > 1 else None, b"".join(own), witness, None if i else root)
                for column, value in zip(out, values):
                    column.append(value)
                offsets.append(offsets[-1] + len(own))
            parts.extend(held)
            digests.clear()
            held.clear()

        def batch_of():
            values = pa.concat_arrays(parts) if parts else pa.array([], kind)
            names = ["tree", "block", "n", "run", "digests", "witness", "root", "rows"]
            steps = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.binary())]))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), steps, pa.binary()]
            arrays = [pa.array(column, k) for column, k in zip(out, kinds)]
            arrays[5] = pa.array([[{"place": p, "siblings": s} for p, s in w] for w in out[5]], steps)
            made = pa.RecordBatch.from_arrays([*arrays, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)], names)
            for column in out:
                column.clear()
            offsets[:] = [0]
            parts.clear()
            return made

        for batch in batches:
            kind = batch.schema.field("row").type
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            sizes, found, row = batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4)
            start = 0
            for i, here in enumerate(keys):
                if here != key:
                    if i > start:
                        held.append(row.slice(start, i - start))
                    if key is not None:
                        close()
                        if len(out[0]) >= BATCH_RUNS:
                            yield batch_of()
                    key, size, start = here, sizes[i], i
                digests.append(found[i])
            if len(keys) > start:
                held.append(row.slice(start, len(keys) - start))
        if key is not None:
            close()
            yield batch_of()

    shape = (
        f"tree string, block bigint, n bigint, run int, digests binary, witness {WITNESS}, root binary, "
        f"rows array<{carried.simpleString()}>"
    )
    bound_batches(nodes.sparkSession)
    return dealt.mapInArrow(rows, shape)


def numbered(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """Rows with their place ``pos`` in their tree and the tree's size ``n``.

    All rows are sorted by ranges, so a tree that holds most of them spans many tasks.
    Counts by tree and task, which are as many as tasks and trees together, give the
    places; they are summed and joined in Spark.
    """
    ranged = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    own = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = stored(ranged.select("*", F.spark_partition_id().alias("_task"), own.alias("_at")), "ranged")
    counts = ranged.groupBy(F.col(tree).alias("_tree"), F.col("_task").alias("_of")).agg(
        F.count("*").alias("_count"), F.min("_at").alias("_first")
    )
    whole = Window.partitionBy("_tree")
    before = F.sum("_count").over(whole.orderBy("_of").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_count")
    counts = counts.select("_tree", "_of", (before - F.col("_first")).alias("_shift"), F.sum("_count").over(whole).alias("n"))
    placed = ranged.join(counts, (F.col("_task") == F.col("_of")) & F.col(tree).eqNullSafe(F.col("_tree")))
    return placed.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_task", "_at", "_tree", "_of", "_shift")


def grown(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The runs of ``appended``, and ``(tree, block, above, top)`` of each block: the
    witness of its root up to the root ``top`` of its tree."""
    runs = stored(appended(nodes), "runs")
    blocks = runs.where("root is not null").select("tree", F.col("block").alias("pos"), "n", F.col("root").alias("digest"))
    empty = F.array().cast(WITNESS)
    done = blocks.where("n = 1").select("tree", F.col("pos").alias("block"), empty.alias("above"), F.col("digest").alias("top"))
    more = blocks.where("n > 1")
    if more.isEmpty():
        return runs, done
    upper, above = grown(more.withColumn("row", F.col("pos")))
    return runs, done.unionByName(witnessed(upper, above).select("tree", F.col("row").alias("block"), F.col("witness").alias("above"), "top"))


def witnessed(runs: DataFrame, above: DataFrame) -> DataFrame:
    """``(tree, row, digest, witness, top)`` of every node: its siblings in its run, those of
    the run within the block, then those of the block."""
    above = above.select(F.col("tree").alias("_tree"), F.col("block").alias("_block"), "above", "top")
    both = runs.join(above, (F.col("block") == F.col("_block")) & F.col("tree").eqNullSafe(F.col("_tree")))
    each = both.select("tree", "run", "digests", F.concat("witness", "above").alias("rest"), "top", F.posexplode("rows").alias("place", "row"))
    start = F.col("place") * 32
    size = F.octet_length("digests")
    siblings = F.concat(F.substring("digests", F.lit(1), start), F.substring("digests", start + 33, size))
    own = F.array(F.struct(F.col("place").alias("place"), siblings.alias("siblings")))
    witness = F.when(F.col("run").isNull(), F.col("rest")).otherwise(F.concat(own, "rest"))
    return each.select("tree", "row", F.substring("digests", start + 1, F.lit(32)).alias("digest"), witness.alias("witness"), "top")


def field_text(name: str) -> Column:
    """A value with its length in front, so that no two rows read alike; ``-`` for NULL."""
    value = F.col(name).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_of(*fields: str) -> Column:
    """Digest of a row, as binary."""
    return F.unhex(F.sha2(F.concat(*map(field_text, fields)), 256))


def hex_of(digest: Column | str) -> Column:
    return F.lower(F.hex(digest))


def folded(leaf: Column, witness: str) -> Column:
    """The root, in hex, that a leaf in hex and a witness lead to."""

    def step(digest: Column, level: Column) -> Column:
        left = level["place"] * 32
        text = F.concat(
            hex_of(F.substring(level["siblings"], F.lit(1), left)), digest,
            hex_of(F.substring(level["siblings"], left + 1, F.octet_length(level["siblings"]))),
        )
        return F.sha2(text, 256)

    return F.aggregate(witness, leaf, step)


def proof_of(witness: str) -> Column:
    """One hash of all siblings of a witness, level by level."""
    return F.sha2(hex_of(F.aggregate(witness, F.lit(b""), lambda all, level: F.concat(all, level["siblings"]))), 256)


def merkle_manifest(
    df: DataFrame, fields: list[str], tree: str = "source", order: str = "doc_id", carry: dict[str, Column] | None = None
) -> DataFrame:
    """The manifest of a table: one row for each of its rows.

    Returns ``order``'s column, ``leaf, subroot, root`` (hex), ``witness`` (for each level
    the node's place and its siblings' digests, one after another) and the columns of
    ``carry``, which are computed from the table's row. A row's leaf is the hash of
    ``fields``. Leaves of a value of ``tree`` (NULL is one of its own) are ordered by
    ``order``, NULL first, then by their digest; their tree's root is ``subroot``. Subroots,
    ordered by ``tree``, NULL first, give ``root`` the same way. Equal rows are leaves of
    their own with equal digests and may trade places. A lone leaf is its own subroot, a
    lone subroot the root. Texts of any length are hashed whole; an empty text differs from
    a NULL. An empty table has no rows. Other columns are ignored, whatever their names.
    """
    extra = carry or {}
    row = F.struct(F.col(order).alias("id"), *[c.alias(f"c{i}") for i, c in enumerate(extra.values())])
    leaves = df.select(
        F.col(tree).cast("string").alias("tree"), F.col(order).alias("place"), leaf_of(*fields).alias("digest"), row.alias("row"),
        # Equal rows get an order too, so that a row that is repeated very often is dealt out.
        F.monotonically_increasing_id().alias("row_id"),
    )
    leaves = stored(leaves, "leaves")
    runs, above = grown(numbered(leaves, "tree", "place", "digest", "row_id").select("tree", "pos", "n", "digest", "row"))
    above = stored(above, "blocks")
    # The trees' roots are the leaves of one more tree.
    tops = above.where("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("row"), F.col("top").alias("digest"))
    upper, last = grown(numbered(tops, "tree", "row").select("tree", "pos", "n", "digest", "row"))
    trees = stored(witnessed(upper, last).select(F.col("row").alias("_of"), F.col("witness").alias("_last"), F.col("top").alias("root")), "trees")
    above = above.join(trees, F.col("tree").eqNullSafe(F.col("_of"))).select(
        "tree", "block", F.concat("above", "_last").alias("above"), F.struct("top", "root").alias("top")
    )
    made = witnessed(runs, above)
    return made.select(
        F.col("row.id").alias(order), hex_of("digest").alias("leaf"), hex_of("top.top").alias("subroot"), hex_of("top.root").alias("root"),
        "witness", *[F.col(f"row.c{i}").alias(name) for i, name in enumerate(extra)],
    )
