"""Merkle manifest of a dataset: one tree per group, one over the groups' roots, and folds of single rows.

A parent keeps a copy of its SHA-256 state before each child slot.  To fold a
row, the state before its slot is resumed with the row's (replaced) digest and
the siblings to its right; what lies to its left is in the state already.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorefold.llm.components import written
from scorefold.llm.words import batch_of

#: Nodes that one task builds a subtree of, at most (or ``arity``).
CHUNK = 4096
PATH = "path array<struct<left:binary,right:binary>>"
NODE = "key string, rank long, total long, digest string"


def field(value: Column) -> Column:
    """A value with its length in UTF-8 bytes before it; NULL is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


class Parent:
    """The digest of consecutive children, and the hash state before each of them."""

    __slots__ = ("before", "digest")

    def __init__(self, children: list[bytes]):
        state, self.before = sha256(), []
        for child in children:
            self.before.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()


def subtree(nodes: list[bytes], arity: int, levels: int | None) -> list[tuple[list[bytes], list[Parent]]]:
    """(nodes, their parents) level by level: ``levels`` of them, or until one node remains.

    A chunk of a tree that goes on above it is built to a fixed height; the only chunk of a tree to its root.
    """
    out = []
    while len(nodes) > 1 if levels is None else len(out) < levels:
        parents = [Parent(nodes[i:i + arity]) for i in range(0, len(nodes), arity)]
        out.append((nodes, parents))
        nodes = [p.digest for p in parents]
    return out


def chunk_levels(arity: int) -> int:
    return max(1, sum(arity ** k <= CHUNK for k in range(1, CHUNK.bit_length())))


def siblings(tree: list[tuple[list[bytes], list[Parent]]], at: int, arity: int):
    """(parent, slot, nodes left of the slot, nodes right of it) on the way up from node ``at``."""
    for nodes, parents in tree:
        at, slot = divmod(at, arity)
        begin = at * arity
        yield parents[at], slot, nodes[begin:begin + slot], nodes[begin + slot + 1:begin + arity]


# ---------------------------------------------------------------- ranks


def ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``rank`` (from 0, within ``key``, by ``order``) and ``total`` of the key.

    Rows are dealt by ranges of (key, order), so a key with most of the rows is
    spread; tasks number what they have, and the counts of the tasks, few
    whatever the table, add up to the ranks.
    """
    fields = rows.columns

    def number(batches):
        part, key, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            position = []
            if batch.num_rows:
                runs = pc.run_end_encode(batch.column("key"))
                begin = 0
                for value, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                    n = n if value == key else 0
                    key = value
                    position.append(np.arange(n, n + end - begin))
                    n, begin = n + end - begin, end
            yield batch_of([*fields, "part", "position"], *batch.columns, np.full(batch.num_rows, part, np.int32),
                           np.concatenate([np.empty(0, np.int64), *position]))

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema), "part int, position long"])
    numbered = written(rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order).mapInArrow(number, schema), name)
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = written(numbered.groupBy("key", "part").agg(F.count("*").alias("n")), f"{name}_parts").select(
        "key", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy("key")).alias("total"))
    return numbered.join(parts, ["key", "part"]).select(
        *fields, (F.col("position") + F.col("before")).alias("rank"), "total")


# ---------------------------------------------------------------- up and down the tree


def higher(nodes: DataFrame, arity: int, name: str) -> DataFrame:
    """The nodes a chunk's height up, or the root of a tree that ends before; a root stays."""
    levels = chunk_levels(arity)
    size = arity ** levels

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("rank")
        total = table["total"][0].as_py()
        own = [d.encode() for d in table["digest"].to_pylist()]
        tree = subtree(own, arity, levels if total > size else None)
        top = tree[-1][1][0].digest if tree else own[0]
        return pa.table({"key": table["key"][:1], "rank": [table["rank"][0].as_py() // size],
                         "total": [-(-total // size)], "digest": [top.decode()]})

    chunked = nodes.select("key", "rank", "total", "digest", F.expr(f"rank div {size}").alias("chunk"))
    return written(chunked.groupBy("key", "chunk").applyInArrow(build, NODE), name)


def tiers(nodes: DataFrame, arity: int, name: str) -> list[DataFrame]:
    """``nodes`` and what lies above them, up to one root a key."""
    out = [nodes]
    while (out[-1].agg(F.max("total")).first()[0] or 0) > 1:
        out.append(higher(out[-1], arity, f"{name}_{len(out)}"))
    return out


def lower(nodes: DataFrame, above: DataFrame, arity: int, name: str) -> DataFrame:
    """Each node with its path to the very root: the siblings inside its chunk, then the chunk's own path."""
    levels = chunk_levels(arity)
    size = arity ** levels

    def paths(own: pa.Table, up: pa.Table) -> pa.Table:
        own = own.sort_by("rank")
        tree = subtree([d.encode() for d in own["digest"].to_pylist()], arity, levels if own["total"][0].as_py() > size else None)
        rest = up["path"].to_pylist()[0]
        path = [[*({"left": b"".join(left), "right": b"".join(right)} for _, _, left, right in siblings(tree, i, arity)), *rest]
                for i in range(len(own))]
        n = len(own)
        return pa.table({"key": own["key"], "rank": own["rank"], "path": pa.array(path, pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))),
                         "subroot": up["subroot"].to_pylist() * n, "root": up["root"].to_pylist() * n})

    return written(cogrouped(nodes.select("key", "rank", "total", "digest"), above, size).applyInArrow(
        paths, f"key string, rank long, {PATH}, subroot string, root string"), name)


def cogrouped(nodes: DataFrame, above: DataFrame, size: int):
    chunk = nodes.withColumn("chunk", F.expr(f"rank div {size}"))
    return chunk.groupBy("key", "chunk").cogroup(above.withColumnRenamed("rank", "chunk").groupBy("key", "chunk"))


def folded(leaves: DataFrame, above: DataFrame, arity: int) -> DataFrame:
    """Per leaf: (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)."""
    levels = chunk_levels(arity)
    size = arity ** levels

    def fold(own: pa.Table, up: pa.Table) -> pa.Table:
        own = own.sort_by("rank")
        leaf = own["digest"].to_pylist()
        tree = subtree([d.encode() for d in leaf], arity, levels if own["total"][0].as_py() > size else None)
        above_path, root, subroot = up["path"].to_pylist()[0], up["root"][0].as_py(), up["subroot"][0].as_py()
        # The parents above this chunk: their states before the chunk's slot, resumed by every leaf of the chunk.
        resumed = [(sha256(p["left"]), p["right"]) for p in above_path]
        upper = b"".join(p["left"] + p["right"] for p in above_path)
        proofs, roots = [], []
        for i, changed in enumerate(own["changed"].to_pylist()):
            value, proof = (changed or leaf[i]).encode(), sha256()
            for parent, slot, left, right in siblings(tree, i, arity):
                state = parent.before[slot].copy()
                state.update(value)
                for other in left:
                    proof.update(other)
                for other in right:
                    state.update(other)
                    proof.update(other)
                value = state.hexdigest().encode()
            for before, right in resumed:
                state = before.copy()
                state.update(value + right)
                value = state.hexdigest().encode()
            proof.update(upper)
            proofs.append(proof.hexdigest())
            roots.append(value.decode())
        n = len(leaf)
        return pa.table({"doc_id": own["doc_id"], "leaf": own["digest"], "subroot": [subroot] * n, "root": [root] * n,
                         "proof_sha256": proofs, "folded_root": roots, "verified": [r == root for r in roots]})

    return cogrouped(leaves, above, size).applyInArrow(
        fold, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


# ---------------------------------------------------------------- the operator


def leaves_of(docs: DataFrame, columns: list[str], group: str, identity: str, changed: Column | None = None) -> DataFrame:
    """(key, doc_id, digest, changed): digests of rows, and those of rows as changed (NULL where they are not).

    ``key`` is the group with a mark that orders NULL before every text.
    """
    whole = digest(*map(F.col, columns))
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-")).alias("key"),
        F.col(identity).cast("long").alias("doc_id"), whole.alias("digest"),
        (F.lit(None).cast("string") if changed is None else changed).alias("changed"))


def manifest(leaves: DataFrame, arity: int = 2) -> DataFrame:
    """One row per leaf of ``leaves_of``: the roots, a digest of its proof, and the root that its changed digest folds to.

    Leaves of a key ascend by doc_id (NULL first), then by digest; equal rows
    may change places.  A key with one leaf has that leaf as its root; keys
    ascend, and their roots form the upper tree in the same way.  Trees are
    built in chunks of up to ``CHUNK`` nodes, so a key of any size is many
    tasks, and the number of passes grows with the logarithm of the rows.  An
    empty table gives no rows.
    """
    rows = written(leaves, "leaves")
    base = ranked(rows, ["doc_id", "digest", "changed"], "ranked_leaves")
    below = tiers(base, arity, "tier")
    # The key orders the roots of the upper tree, whose only group is the empty name.
    roots = below[-1].select(F.lit("").alias("key"), F.col("key").alias("name"), "digest")
    top = tiers(ranked(roots, ["name"], "subroots"), arity, "top")
    none = F.expr(f"cast(array() as {PATH.removeprefix('path ')})").alias("path")
    paths = top[-1].select("key", "rank", none, F.lit("").alias("subroot"), F.col("digest").alias("root"))
    for i, tier in enumerate(reversed(top[:-1])):
        paths = lower(tier, paths, arity, f"top_paths_{i}")
    named = top[0].select("rank", F.col("name").alias("key"), F.col("digest").alias("subroot"))
    paths = paths.select("rank", "path", "root").join(named, "rank").select("key", F.lit(0).cast("long").alias("rank"), "path", "subroot", "root")
    for i, tier in enumerate(reversed(below[1:-1])):
        paths = lower(tier, paths, arity, f"paths_{i}")
    return folded(base, paths, arity)
