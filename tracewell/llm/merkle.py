"""Merkle manifest of a dataset: a tree of digests a group, and a tree over the groups' roots.

Every row is a leaf, the digest of its fields. Leaves of a group ascend by key; every `FANOUT`
consecutive nodes become one until a single one, the group's root, remains, and the roots of all
groups, ordered by group, become the dataset's root in the same way.

Work goes by aligned blocks of FANOUT ** LEVELS nodes, one task a block: a block's nodes are a
contiguous numpy matrix of 64-byte hex digests; reshaped by the fanout, each of its rows is hashed to a node
of the next level; the siblings of node i are rows i // FANOUT * FANOUT and on, without i: index
arithmetic, no links. A block yields one node; blocks of those are the next round, until one node a
tree is left (three rounds hold 4096 ** 3 leaves). On the way back, each round's blocks meet the paths
of their own nodes and extend them, so a leaf's whole path exists only inside its task.

Rows are numbered within their group after one range sort of the digests (not of the texts), by
partition and place; a last sort key is the number of the row in the written table, so that neither
one group nor one key with a third of the rows makes a large task.

Defined cases: a null field is hashed as `-`, any other as its length in UTF-8 bytes, `:` and its text;
the null group comes first, as does a null key in its group; rows of equal keys are ordered by their
digest, and repeated rows are leaves of their own; an empty table gives no rows; extra columns are
ignored, whatever their names. A path holds, for each level, the number of siblings before and after
and their digests; proofs are the digest of the siblings alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from tracewell.llm.common import saved

FANOUT, LEVELS = 8, 4  # a block: FANOUT ** LEVELS nodes
HEX = 64


def field(value: Column) -> Column:
    """A field as it is hashed."""
    told = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(told).cast("string"), F.lit(":"), told), F.lit("-"))


def digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def _matrix(digests: list[str]) -> np.ndarray:
    return np.frombuffer("".join(digests).encode(), np.uint8).reshape(-1, HEX)


def levels(nodes: np.ndarray, fanout: int, steps: int, alone: bool) -> list[np.ndarray]:
    """The digest matrices of a block from `nodes` up to a single row. `alone`: the block holds a whole
    tree, which ends as soon as one node is left; otherwise it has `steps` levels above its nodes."""
    out = [nodes]
    while len(out[-1]) > 1 if alone else len(out) <= steps:
        below = out[-1]
        whole = len(below) // fanout
        runs = [memoryview(r) for r in np.ascontiguousarray(below[: whole * fanout]).reshape(whole, fanout * HEX)]
        if whole * fanout < len(below):
            runs.append(memoryview(np.ascontiguousarray(below[whole * fanout :]).reshape(-1)))
        out.append(_matrix([sha256(r).hexdigest() for r in runs]))
    return out


def siblings(flat: list[bytes], fanout: int, i: int) -> Iterator[tuple[bytes, bytes]]:
    """For each level below the last, the siblings before and after node `i` of the first level;
    `flat`: the levels' bytes."""
    for level in flat[:-1]:
        run = i // fanout * fanout
        yield level[run * HEX : i * HEX], level[(i + 1) * HEX : (run + fanout) * HEX]
        i //= fanout


def pack_path(steps: list[tuple[bytes, bytes]]) -> bytes:
    """A path as bytes: for each level the counts of siblings before and after, then their digests."""
    return b"".join(bytes([len(a) // HEX, len(b) // HEX]) + a + b for a, b in steps)


def read_path(path: bytes) -> list[tuple[bytes, bytes]]:
    out, at = [], 0
    while at < len(path):
        a, b = (n * HEX for n in path[at : at + 2])
        out.append((path[at + 2 : at + 2 + a], path[at + 2 + a : at + 2 + a + b]))
        at += 2 + a + b
    return out


def proof(path: list[tuple[bytes, bytes]]) -> str:
    """Digest of all siblings, level by level, left to right."""
    out = sha256()
    for a, b in path:
        out.update(a)
        out.update(b)
    return out.hexdigest()


def fold(leaf: str, path: list[tuple[bytes, bytes]]) -> str:
    """The root that a leaf and the siblings on its path lead to."""
    for a, b in path:
        leaf = sha256(a + leaf.encode() + b).hexdigest()
    return leaf


def _blocks(nodes: DataFrame, block: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"place div {block}"))


def _roots(nodes: DataFrame, fanout: int, steps: int) -> DataFrame:
    """One node a block, as nodes of the next round."""
    block = fanout**steps

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        size = rows.column("size")[0].as_py()
        top = levels(_matrix(rows.column("digest").to_pylist()), fanout, steps, size <= block)[-1]
        return pa.table({"tree": pa.array([key[0].as_py()], pa.string()), "size": [-(-size // block)], "place": [key[1].as_py()], "digest": [top.tobytes().decode()]})

    return _blocks(nodes.select("tree", "size", "place", "digest"), block).groupBy("tree", "block").applyInArrow(run, "tree string, size bigint, place bigint, digest string")


def _paths(nodes: DataFrame, above: DataFrame, fanout: int, steps: int) -> DataFrame:
    """(tree, place, subroot, root, path): every node's path from its own level up. `above` has that of
    each block's node."""
    block = fanout**steps

    def run(rows: pa.Table, upper: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        flat, n = _flat(rows, fanout, steps), len(rows)
        rest, subroot, root = (upper.column(c)[0].as_py() for c in ("path", "subroot", "root"))
        paths = [pack_path(list(siblings(flat, fanout, i))) + rest for i in range(n)]
        return pa.table({"tree": rows.column("tree"), "place": rows.column("place"), "subroot": pa.array([subroot] * n, pa.string()), "root": pa.array([root] * n, pa.string()), "path": pa.array(paths, pa.binary())})

    return _met(nodes.select("tree", "size", "place", "digest"), above, block).applyInArrow(run, "tree string, place bigint, subroot string, root string, path binary")


def _met(nodes: DataFrame, above: DataFrame, block: int) -> PandasCogroupedOps:
    """Each block of nodes beside the row of the node that it becomes."""
    return _blocks(nodes, block).groupBy("tree", "block").cogroup(above.withColumnRenamed("place", "block").groupBy("tree", "block"))


def _flat(rows: pa.Table, fanout: int, steps: int) -> list[bytes]:
    """The levels' bytes of a sorted block."""
    size = rows.column("size")[0].as_py()
    return [m.tobytes() for m in levels(_matrix(rows.column("digest").to_pylist()), fanout, steps, size <= fanout**steps)]


def climb(nodes: DataFrame, fanout: int = FANOUT, steps: int = LEVELS) -> list[DataFrame]:
    """Rounds of nodes (tree, size, place, digest), the given ones first, until each tree has one."""
    out = [nodes]
    while (out[-1].agg(F.max("size")).first()[0] or 0) > (1 if len(out) > 1 else 0):
        out.append(saved(_roots(out[-1], fanout, steps), "merkle-nodes"))
    return out


def placed(rows: DataFrame, tree: Column, order: list[str]) -> DataFrame:
    """`rows` with their `tree`, its `size` and their `place` in it by `order`, from 0. Rows are sorted by
    range; a partition's rows of a tree follow those that earlier partitions have of it."""
    rows = rows.withColumn("tree", tree)
    keys = [F.col("tree").asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order)]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    number = F.monotonically_increasing_id()  # partition and place in it
    dealt = saved(dealt.select("*", F.shiftright(number, 33).alias("_part"), number.bitwiseAND(2**33 - 1).alias("_at")), "merkle-sorted")
    counts = dealt.groupBy("tree", "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))  # a row a tree and partition
    whole = Window.partitionBy("tree")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("tree").alias("_tree"), F.col("_part").alias("_of"), F.sum("_n").over(whole).alias("size"), (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_from"))
    met = F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("_part") == F.col("_of"))
    return dealt.join(starts, met).withColumn("place", F.col("_from") + F.col("_at")).drop("_tree", "_of", "_part", "_at", "_from")


def leaves(docs: DataFrame, group: str, key: str, fields: list[str], tampered: Column | None = None, altered: dict[str, Column] | None = None) -> DataFrame:
    """(key, tree, size, place, digest[, other]): every row as a leaf of its group's tree. Where `tampered`
    holds, `other` is the digest of the row with the columns of `altered` in place of its own, elsewhere
    null."""
    own = [F.col(c) for c in fields]
    rows = docs.select(F.col(key).alias("key"), F.col(group).cast("string").alias("group"), digest(own).alias("digest"), *_other(fields, tampered, altered), F.monotonically_increasing_id().alias("_row"))
    return placed(saved(rows, "merkle-leaves"), F.col("group"), ["key", "digest", "_row"]).drop("_row", "group")


def _other(fields: list[str], tampered: Column | None, altered: dict[str, Column] | None) -> list[Column]:
    if tampered is None:
        return []
    other = digest([(altered or {}).get(c, F.col(c)) for c in fields])
    return [F.when(tampered, other).alias("other")]


def manifest(nodes: DataFrame, fanout: int = FANOUT, steps: int = LEVELS, with_paths: bool = False) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root[, path]) for leaves as `leaves` gives them.
    `folded_root` is worked out from `other`, where it is given, else from the leaf, along the leaf's path;
    it equals the root only if the leaf is the original one."""
    rounds = climb(nodes.select("tree", "size", "place", "digest"), fanout, steps)
    tops = rounds[-1].select(F.col("tree").alias("group"), "digest")
    # The roots of all groups are the nodes of one more tree.
    forest = climb(placed(tops, F.lit(""), ["group"]), fanout, steps)
    above = forest[-1].select("tree", "place", F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"), F.lit(b"").alias("path"))
    for found in forest[-2::-1]:
        above = _paths(found, above, fanout, steps)
    groups = forest[0].select(F.col("group").alias("tree"), F.col("digest").alias("_subroot"), F.col("place").alias("_at"))
    above = groups.join(above.drop("tree", "subroot"), F.col("_at") == F.col("place"))  # a row a group
    above = saved(above.select("tree", F.lit(0).cast("long").alias("place"), F.col("_subroot").alias("subroot"), "root", "path"), "merkle-above")
    for found in rounds[-2:0:-1]:
        above = _paths(found, above, fanout, steps)
    kind = dict(nodes.dtypes)["key"]
    tampered = "other" in nodes.columns

    def run(rows: pa.Table, upper: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        flat, n = _flat(rows, fanout, steps), len(rows)
        rest, subroot, root = read_path(upper.column("path")[0].as_py()), upper.column("subroot")[0].as_py(), upper.column("root")[0].as_py()
        own = rows.column("digest").to_pylist()
        other = rows.column("other").to_pylist() if tampered else [None] * n
        paths = [list(siblings(flat, fanout, i)) + rest for i in range(n)]
        out = {"key": rows.column("key"), "leaf": rows.column("digest"), "subroot": [subroot] * n, "root": [root] * n}
        out |= {"proof_sha256": [proof(p) for p in paths], "folded_root": [fold(b or a, p) for a, b, p in zip(own, other, paths, strict=True)]}
        if with_paths:
            out["path"] = pa.array([pack_path(p) for p in paths], pa.binary())
        return pa.table(out)

    return _met(nodes, above, fanout**steps).applyInArrow(run, f"key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string" + ", path binary" * with_paths)
