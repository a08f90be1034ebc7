"""Merkle manifest of a table as a persistent tree: a changed leaf makes a version that copies only its ancestors.

The tree is cut into aligned blocks of 2**BITS leaves. A block is one group of rows:
its nodes stand in an append-only store, and each changed leaf adds a version, that is,
a new node for every ancestor whose other child is a node that was there before. Roots
of blocks are the leaves of the next level's blocks, up to one root a tree; the trees'
roots, in the trees' order, are the leaves of one more tree. A version goes on above
its block where its row is: each upper ancestor is copied over the untouched nodes
beside the path, which all leaves of a block share and which are joined by block.

Only digests are shuffled: texts are hashed where they are read.

Defined cases: null fields hash as ``-``; a null tree name (lang) is a tree of its own
before the others; rows with equal ids go by their leaf digests, equal rows count each;
null ids come first and are never changed; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Leaves of an aligned block, as a power of two.
BITS = 10

STEP = "struct<beside_left:binary,beside_right:binary>"
BLOCK_ROWS = f"tree string, pos long, row long, steps array<{STEP}>, copied array<binary>, block_root binary"


def field(value: Column) -> Column:
    """A field inside a leaf: ``-`` if null, else its bytes' count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256))


def shown(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def joined(*digests: Column) -> Column:
    """Digest of the digests' hex texts, one after another; null ones add nothing."""
    return F.unhex(F.sha2(F.concat(*[F.coalesce(shown(d), F.lit("")) for d in digests]).cast("binary"), 256))


class PersistentBlock:
    """Nodes of one block, never changed once made; a version is the number of its root node.

    A node is its digest and the numbers of its one or two children (none: a leaf).
    """

    def __init__(self, leaves: list[bytes], height: int):
        self.digest: list[bytes] = list(leaves)
        self.children: list[tuple[int, ...]] = [()] * len(leaves)
        self.height = height
        level = list(range(len(leaves)))
        for _ in range(height):
            level = [self._add(tuple(level[i:i + 2])) for i in range(0, len(level), 2)]
        (self.root,) = level

    def _add(self, children: tuple[int, ...]) -> int:
        self.digest.append(sha256("".join(self.digest[c].hex() for c in children).encode()).digest())
        self.children.append(children)
        return len(self.digest) - 1

    def path(self, index: int, root: int) -> list[tuple[int, ...]]:
        """Children of each ancestor of a leaf, from the leaf's parent to the root."""
        steps, node = [], root
        for level in reversed(range(self.height)):
            steps.append(self.children[node])
            node = steps[-1][index >> level & 1]
        return steps[::-1]

    def steps(self, index: int) -> list[tuple[bytes | None, bytes | None]]:
        """The nodes beside the path, left or right of it, from the leaf's level up; both None where a node stands alone."""
        found = []
        for level, pair in enumerate(self.path(index, self.root)):
            right = index >> level & 1
            found.append((self.digest[pair[0]], None) if right else (None, self.digest[pair[1]] if len(pair) > 1 else None))
        return found

    def changed(self, index: int, digest: bytes) -> tuple[int, list[int]]:
        """A version with another digest at a leaf: its root, and the nodes that it does not share, from the leaf up."""
        path = self.path(index, self.root)
        self.digest.append(digest)
        self.children.append(())
        copied = [len(self.digest) - 1]
        for level, pair in enumerate(path):
            copied.append(self._add((pair[0], copied[-1]) if index >> level & 1 else (copied[-1], *pair[1:])))
        return copied[-1], copied


def _blocks(bits: int):
    def block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        tree = PersistentBlock([bytes(d) for d in rows["digest"]], min(bits, max(0, int(rows["n"].iloc[0]) - 1).bit_length()))
        steps = [[{"beside_left": a, "beside_right": b} for a, b in tree.steps(i)] for i in range(len(rows))]
        root, copied = tree.digest[tree.root], []
        for i, new in enumerate(rows["new"]):
            copied.append(None if new is None else [tree.digest[k] for k in tree.changed(i, bytes(new))[1]])
        return pd.DataFrame({"tree": rows["tree"], "pos": rows["pos"], "row": rows["row"], "steps": steps, "copied": copied, "block_root": [root] * len(rows)})

    return block


def _grouped(nodes: DataFrame, bits: int) -> DataFrame:
    """``nodes`` (tree, pos, n, digest, new, row) by aligned blocks: steps beside each node's path, copied nodes of its version, block root."""
    block = F.shiftright("pos", bits).alias("block")
    return nodes.groupBy("tree", block).applyInPandas(_blocks(bits), BLOCK_ROWS)


def _paths(nodes: DataFrame, bits: int, name: str) -> DataFrame:
    """tree, pos, steps up to the tree's root, root, for nodes (tree, pos, n, digest); one block's rows are a group at each level."""
    low = written(_grouped(nodes.select("tree", "pos", "n", "digest", F.lit(None).cast("binary").alias("new"), F.lit(0).cast("long").alias("row")), bits)
                  .select("tree", "pos", "steps", "block_root"), name)
    most = nodes.agg(F.max("n")).first()[0] or 0
    if most <= 1 << bits:
        return low.withColumnRenamed("block_root", "root")
    high = _paths(_parents(low, nodes, bits), bits, name)
    return _with_parents(low, high, bits).select("tree", "pos", F.concat("steps", "up").alias("steps"), "root")


def _parents(low: DataFrame, nodes: DataFrame, bits: int) -> DataFrame:
    """Roots of blocks as the nodes of the next level."""
    roots = low.groupBy("tree", F.shiftright("pos", bits).alias("pos")).agg(F.first("block_root").alias("digest"))
    sizes = nodes.groupBy("tree").agg(F.shiftright(F.max("n") + ((1 << bits) - 1), bits).alias("n"))
    return roots.join(sizes, "tree")


def _with_parents(low: DataFrame, high: DataFrame, bits: int) -> DataFrame:
    above = high.select(F.col("tree").alias("__tree"), F.col("pos").alias("__block"), F.col("steps").alias("up"), "root")
    return low.join(above, (low["tree"] == above["__tree"]) & (F.shiftright(low["pos"], bits) == above["__block"])).drop("__tree", "__block")


def positioned(leaves: DataFrame) -> DataFrame:
    """``leaves`` (tree, key, digest, row, ...) with pos, their place in their tree by (key, digest, row), and n, the tree's size.

    One range shuffle; places come from counts by (partition, tree), so no tree is sorted in one task.
    """
    order = ["tree", "key", "digest", "row"]
    sorted_rows = leaves.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(sorted_rows.select("*", F.monotonically_increasing_id().alias("at")).withColumn("part", F.shiftright("at", 33).cast("int")), "merkle-sorted")
    counts = rows.groupBy("part", "tree").agg(F.min("at").alias("first"), F.count("*").alias("n_here"))
    whole = Window.partitionBy("tree")  # one row a partition and tree
    runs = counts.select(F.col("tree").alias("__tree"), F.col("part").alias("__part"), "first", F.sum("n_here").over(whole).alias("n"),
                         F.coalesce(F.sum("n_here").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return (rows.join(runs, (rows["tree"] == runs["__tree"]) & (rows["part"] == runs["__part"]))
            .withColumn("pos", F.col("at") - F.col("first") + F.col("before")).drop("__tree", "__part", "part", "at", "first", "before"))


@dataclass
class Manifest:
    """``leaves``: row, key, tree, pos, digest, new (a changed leaf's digest or null), steps (nodes beside the path, from the leaf to
    the root of all), subroot, root, copied (digests of the nodes that the leaf's own version does not share, leaf first, or null).
    ``roots``: tree, subroot, root."""

    leaves: DataFrame
    roots: DataFrame


def _continued(copied: Column, steps: Column) -> Column:
    """A version's copied nodes, continued over the untouched nodes beside its path."""
    def copy(made: Column, step: Column) -> Column:
        return F.concat(made, F.array(joined(step["beside_left"], F.element_at(made, -1), step["beside_right"])))

    return F.when(copied.isNotNull(), F.aggregate(steps, copied, copy))


def build(leaves: DataFrame, bits: int = BITS) -> Manifest:
    """The manifest of ``leaves``: tree, key (orders a tree's leaves), digest, new (null: the leaf is not changed).

    ``tree`` is compared by bytes, null first. Each row with ``new`` gets a version in which it alone is changed.
    """
    name = F.coalesce(F.concat(F.lit("+"), "tree"), F.lit(""))  # null before all
    rows = written(leaves.select(name.alias("tree"), "key", "digest", "new").withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    placed = written(positioned(rows), "merkle-placed")
    low = written(_grouped(placed.select("tree", "pos", "n", "digest", "new", "row"), bits), "merkle-blocks")
    blocks = _parents(low, placed, bits)
    up = _paths(blocks, bits, "merkle-upper")
    tops = up.groupBy("tree").agg(F.first("root").alias("digest"))
    forest = positioned(tops.select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest", F.lit(0).cast("long").alias("row")))
    forest = written(forest.select("tree", "pos", "n", "digest", F.col("key").alias("of")), "merkle-forest")
    over = _paths(forest.drop("of"), bits, "merkle-roots")
    roots = (forest.select("pos", F.col("of").alias("tree"), F.col("digest").alias("subroot"))
             .join(over.select("pos", F.col("steps").alias("over"), "root"), "pos").drop("pos"))
    above = written(up.select("tree", "pos", F.col("steps").alias("up")).join(roots, "tree")
                    .select(F.col("tree").alias("__tree"), F.col("pos").alias("__block"), F.concat("up", "over").alias("up"), "subroot", "root"), "merkle-above")
    grown = low.join(above, (low["tree"] == above["__tree"]) & (F.shiftright(low["pos"], bits) == above["__block"]))
    grown = grown.select("row", F.concat("steps", "up").alias("steps"), _continued(F.col("copied"), F.col("up")).alias("copied"), "subroot", "root")
    unnamed = F.when(F.col("tree") != "", F.substr("tree", F.lit(2)))
    return Manifest(placed.drop("n").join(grown, "row").withColumn("tree", unnamed), roots.select(unnamed.alias("tree"), "subroot", "root"))


def refolded(digest: Column, steps: Column) -> Column:
    """The root that a leaf's digest and the nodes beside its path come to."""
    return F.aggregate(steps, digest, lambda made, s: joined(s["beside_left"], made, s["beside_right"]))


def proof(steps: Column) -> Column:
    """The siblings' digests as hex texts, level by level."""
    return F.aggregate(steps, F.lit(""), lambda text, s: F.concat(text, F.coalesce(shown(s["beside_left"]), F.lit("")), F.coalesce(shown(s["beside_right"]), F.lit(""))))


def document_leaves(docs: DataFrame) -> DataFrame:
    """A leaf per document in its language's tree; where 7 divides the id's crc32, ``new`` is the leaf with n_chars one higher."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    more = (F.col("n_chars").cast("decimal(20,0)") + F.lit(1)).cast("string")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return docs.select(F.col("lang").alias("tree"), F.col("doc_id").alias("key"), leaf(*fields).alias("digest"),
                       F.when(hit, leaf(*fields[:3], more, fields[4])).alias("new"))


def verify(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, copied_nodes.

    A tampered document's ``folded_root`` is the root of its version, every other one's is folded from its leaf over its proof.
    """
    leaves = build(document_leaves(docs), bits).leaves
    again = F.when(F.col("copied").isNotNull(), F.element_at("copied", -1)).otherwise(refolded(F.col("digest"), F.col("steps")))
    leaves = leaves.withColumn("folded", again)
    folded = F.col("folded")
    return leaves.select(
        F.col("key").alias("doc_id"), shown(F.col("digest")).alias("leaf"), shown(F.col("subroot")).alias("subroot"), shown(F.col("root")).alias("root"),
        F.sha2(proof(F.col("steps")).cast("binary"), 256).alias("proof_sha256"), shown(folded).alias("folded_root"),
        (folded == F.col("root")).alias("verified"), F.coalesce(F.size("copied"), F.lit(0)).alias("copied_nodes"))


def oracle() -> str:
    bit = "CASE WHEN (xor(c, b) & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, bits), lambda c, b: {bit}), 4294967295)"

    def fields(n_chars: str) -> str:
        values = ("doc_id", "source", "lang", n_chars, "text")
        return "sha256(" + " || ".join(f"coalesce(octet_length(encode(({v})::VARCHAR))::VARCHAR || ':' || ({v})::VARCHAR, '-')" for v in values) + ")"

    return f"""
        WITH RECURSIVE d AS (
          SELECT *, coalesce('+' || lang, '') AS tree, {fields('n_chars')} AS leaf, {fields('n_chars::HUGEINT + 1')} AS new,
                 flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1),
                   lambda i: list_transform(range(0, 8), lambda k: (ascii(substr(doc_id::VARCHAR, i, 1)) >> k)::BIGINT & 1))) AS bits
          FROM documents),
        p AS (SELECT *, row_number() OVER w - 1 AS pos, {crc} % 7 = 0 AS hit FROM d
              WINDOW w AS (PARTITION BY tree ORDER BY encode(tree), doc_id NULLS FIRST, leaf)),
        nodes AS (
          SELECT tree, 0 AS lvl, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM p
          UNION ALL
          SELECT tree, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM nodes WHERE n > 1 GROUP BY tree, lvl, pos // 2, n),
        tops AS (SELECT tree, lvl, h AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
        forest AS (
          SELECT 0 AS lvl, pos, subroot AS h, n FROM tops
          UNION ALL
          SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM forest WHERE n > 1 GROUP BY lvl, pos // 2, n),
        steps AS (
          SELECT p.doc_id, p.tree, p.pos, l.lvl, s.h, (p.pos >> l.lvl) & 1 AS from_right
          FROM p JOIN tops t ON p.tree = t.tree, LATERAL (SELECT unnest(range(0, t.lvl)) AS lvl) l
          LEFT JOIN nodes s ON s.tree = p.tree AND s.lvl = l.lvl AND s.pos = xor(p.pos >> l.lvl, 1)
          UNION ALL
          SELECT p.doc_id, p.tree, p.pos, 1000 + l.lvl, s.h, (t.pos >> l.lvl) & 1
          FROM p JOIN tops t ON p.tree = t.tree, LATERAL (SELECT unnest(range(0, (SELECT max(lvl) FROM forest))) AS lvl) l
          LEFT JOIN forest s ON s.lvl = l.lvl AND s.pos = xor(t.pos >> l.lvl, 1)),
        proofs AS (
          SELECT tree, pos, string_agg(coalesce(h, ''), '' ORDER BY lvl) AS proof,
                 list(CASE WHEN h IS NULL THEN '-' WHEN from_right = 1 THEN 'L' || h ELSE 'R' || h END ORDER BY lvl) AS path
          FROM steps GROUP BY tree, pos),
        folded AS (
          SELECT p.*, t.subroot, (SELECT h FROM forest WHERE n = 1) AS root, coalesce(f.proof, '') AS proof,
                 list_reduce(list_prepend(CASE WHEN hit THEN new ELSE leaf END, coalesce(f.path, [])),
                   lambda a, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || a WHEN s[1] = 'R' THEN a || s[2:] ELSE a END)) AS folded_root
          FROM p JOIN tops t ON p.tree = t.tree LEFT JOIN proofs f ON f.tree = p.tree AND f.pos = p.pos)
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified,
               CASE WHEN hit THEN 1 + len(coalesce((SELECT path FROM proofs f WHERE f.tree = folded.tree AND f.pos = folded.pos), [])) ELSE 0 END::INTEGER AS copied_nodes
        FROM folded
    """
