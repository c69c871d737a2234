"""Merkle manifest of a data set, with a proof for every document.

Every document is a leaf.  The leaves of a group (``source``), in the order of their ids,
are the lowest level of the group's tree; ``FAN`` consecutive nodes of a level become one node of the
next (the last run may hold fewer, even one) until one is left, the subroot.  The
subroots, in the order of their groups, are the lowest level of the tree that gives the root.
A node is the SHA-256 of its children's lowercase hex digests, concatenated.

**Building.**  The leaves are range-partitioned by (group, id, leaf) and written once, each with its
number in the whole order; a group's leaves are the numbers from its first one on.  Blocks of
``FAN ** HEIGHT`` neighbours are one group of rows each, which yields all nodes of
``HEIGHT`` levels; the blocks' tops are the next round's leaves, so rounds are the
logarithm of the rows to the base of the block.  Small groups of documents share
a block, a hot one is cut into many: no task holds more than ``2 * FAN ** HEIGHT`` digests.

**Proofs: octopus multiproof.**  A leaf partition is ``PARTITION`` neighbours in the whole order.  From
the numbers of the leaves it wants to prove alone, each partition derives the minimal union of the
nodes that it cannot compute itself, over all its proofs; one join fetches those for all
partitions.  Each partition then derives the interior nodes that its proofs share, once, and expands them
to one list of siblings per document, in its own task.

A document's ``claim`` (its leaf, or the leaf of an altered copy) is folded with the siblings to
``folded_root``; ``verified`` says whether that is the root.

Edge cases: a null id, group or other field is hashed as ``-``, null ids and groups come first;
repeated rows are leaves each, in the order of their digests (equal leaves are interchangeable);
an empty table has no rows and no root; very long texts are hashed in the scan's
tasks and never shuffled; other columns play no part and are not returned.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenecast.llm.common import CRC32_SQL, drop_stored, require, stored

FAN = 3
HEIGHT = 8                 # levels built by one task: blocks of 6,561 nodes
PARTITION = 8_192          # leaves whose proofs one task expands
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = -1                   # the tree of the subroots


def node(children: list[bytes]) -> bytes:
    """Digest of a node from its children's digests."""
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def framed(value: Column) -> Column:
    """A field inside a leaf: its UTF-8 length and its text; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """Lowercase hex digest of a document's fields."""
    return F.sha2(F.concat(*[framed(v) for v in values]).cast("binary"), 256)


def numbered(df: DataFrame, order: list[str], name: str, out: str = "_g") -> DataFrame:
    """Write the rows range-partitioned and sorted by ``order``, each with its number ``out``.

    A row's place in its partition comes with the sort; the rows of the partitions
    before it are added from one count a partition.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(ranged.withColumn("_at", F.monotonically_increasing_id()), name)
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    counts = rows.groupBy(part.alias("_part")).count().orderBy("_part").collect()
    first, seen = [], 0
    for r in counts:                       # one number a partition of the write
        first.append((r["_part"], seen))
        seen += r["count"]
    before = spark.createDataFrame(first, "_part long, _before long")
    return (rows.withColumn("_part", part).join(before, "_part")
            .withColumn(out, F.col("_before") + place).drop("_at", "_part", "_before"))


# --- building ---------------------------------------------------------------

def _levels(size: int) -> list[int]:
    """Nodes on each level of a tree of ``size`` leaves, up to its root."""
    sizes = [size]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // FAN))
    return sizes


def _grow(block: pd.DataFrame, height: int) -> pd.DataFrame:
    """The nodes of up to ``height`` levels above the block's nodes, tree by tree."""
    out = []
    for (tree, size, level), part in block.groupby(["tree", "size", "level"], sort=False):
        part = part.sort_values("pos")
        at, digests = int(part["pos"].iloc[0]), part["digest"].tolist()
        for up in range(1, height + 1):
            if size == 1:
                break
            size = -(-size // FAN)
            at //= FAN
            digests = [node(digests[i:i + FAN]) for i in range(0, len(digests), FAN)]
            out.extend((tree, size, level + up, at + i, d) for i, d in enumerate(digests))
    return pd.DataFrame(out, columns=["tree", "size", "level", "pos", "digest"])


_NODE = "tree long, size long, level int, pos long, digest binary"


def _interior(lowest: DataFrame, largest: int, height: int, name: str) -> DataFrame:
    """All nodes above the rows (tree, size, level 0, pos, digest) of many trees.

    Trees of at most one block are dealt together by their number, which is the first
    of their leaves' numbers; larger ones are cut into blocks.
    """
    spark, block = lowest.sparkSession, FAN ** height
    nodes, made = lowest.filter("size > 1"), []
    while largest > 1:
        small = F.col("size") <= block
        rows = nodes.select(
            *[F.col(c) for c in ("tree", "size", "level", "pos", "digest")],
            F.when(small, F.floor(F.col("tree") / block)).otherwise(F.col("tree")).alias("_b1"),
            F.when(small, F.lit(-1)).otherwise(F.floor(F.col("pos") / block)).alias("_b2"))
        above = stored(rows.groupBy("_b1", "_b2").applyInPandas(
            lambda pdf: _grow(pdf, height), _NODE), f"{name}-nodes")
        made.append(above)
        largest = -(-largest // block)
        nodes = above.filter((F.col("level") == len(made) * height) & (F.col("size") > 1))
    if not made:
        return spark.createDataFrame([], _NODE)
    out = made[0]
    for more in made[1:]:
        out = out.unionByName(more)
    return out


@dataclass
class Manifest:
    """``leaves``: one row a document (the kept columns, leaf, tree, size, pos, rank, number ``g``);
    ``nodes``: all other nodes (tree, level, pos, digest); ``groups``: subroot of every group;
    ``root``: lowercase hex, null for an empty table."""

    leaves: DataFrame
    nodes: DataFrame
    groups: DataFrame
    root: str | None
    n_groups: int
    parts: list[DataFrame]

    def drop(self) -> None:
        """Delete the files behind the manifest."""
        for df in self.parts:
            drop_stored(df)


def build(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id",
          group_col: str = "source", keep: dict[str, Column] | None = None,
          height: int = HEIGHT) -> Manifest:
    """The manifest of all rows; ``keep`` adds named columns to its leaves."""
    require(docs, *fields, id_col, group_col)
    # written before the ranges are drawn, which reads the rows twice
    hashed = stored(docs.select(
        F.col(id_col).alias("id"), F.col(group_col).alias("grp"),
        F.unhex(leaf(*[F.col(f) for f in fields])).alias("leaf"),
        *[c.alias(n) for n, c in (keep or {}).items()]), "merkle-hashed")
    rows = numbered(hashed, ["grp", "id", "leaf"], "merkle-leaves", "g")
    drop_stored(hashed)
    # a group's first number is its tree
    trees = numbered(rows.groupBy("grp").agg(F.min("g").alias("tree"), F.count("g").alias("size")),
                     ["tree"], "merkle-groups", "rank")
    placed = (rows.join(trees.withColumnRenamed("grp", "_grp"), F.col("grp").eqNullSafe(F.col("_grp")))
              .drop("_grp").withColumn("pos", F.col("g") - F.col("tree")))
    leaves = stored(placed, "merkle-placed")
    drop_stored(rows)
    n_groups, largest = trees.agg(F.count("tree"), F.max("size")).first()
    below = _interior(leaves.select("tree", "size", F.lit(0).alias("level"), "pos",
                                    F.col("leaf").alias("digest")), largest or 0, height,
                      "merkle")
    tops = (leaves.filter("size = 1").select("tree", F.col("leaf").alias("digest"))
            .unionByName(below.filter("size = 1").select("tree", "digest")))
    groups = stored(trees.join(tops, "tree").select("grp", "tree", "size", "rank",
                                                    F.col("digest").alias("subroot")),
                    "merkle-subroots")
    lowest = groups.select(F.lit(TOP).cast("long").alias("tree"), F.lit(n_groups).cast("long").alias(
        "size"), F.lit(0).alias("level"), F.col("rank").alias("pos"),
        F.col("subroot").alias("digest"))
    upper = _interior(lowest, n_groups, height, "merkle-top").unionByName(lowest)
    top = upper.filter("size = 1").first()
    return Manifest(leaves, below.unionByName(upper).drop("size"), groups,
                    top["digest"].hex() if top else None, n_groups,
                    [leaves, groups, trees, below, upper])


# --- proofs -----------------------------------------------------------------

def _runs(known, size: int):
    """The runs of one level that hold a known place: (run, its places)."""
    for run in sorted({p // FAN for p in known}):
        yield run, range(run * FAN, min(size, run * FAN + FAN))


def missing(places: dict[tuple[int, int], set[int]]) -> list[tuple[int, int, int]]:
    """The least (tree, level, pos) to fetch so that all wanted leaves have their proofs.

    ``places``: the wanted leaves per (tree, size).  What is not fetched follows from the wanted
    leaves and what is fetched.  The subroots' places are given as tree ``TOP``.
    """
    need = []
    for (tree, size), known in places.items():
        for level, count in enumerate(_levels(size)[:-1]):
            need += [(tree, level, p) for _, run in _runs(known, count) for p in run
                     if p not in known]
            known = {p // FAN for p in known}
    return need


def _wanted(rows: pd.DataFrame, n_groups: int) -> dict[tuple[int, int], set[int]]:
    places = {(int(t), int(s)): set(p) for (t, s), p in
              rows.groupby(["tree", "size"], sort=False)["pos"]}
    places[TOP, n_groups] = set(rows["rank"])
    return places


def _tree_nodes(tree: int, size: int, lowest: dict[int, bytes], fetched: dict
                ) -> list[dict[int, bytes]]:
    """Digests by level: the wanted nodes, the fetched ones and the shared interiors above."""
    levels = [dict(lowest)]
    for level, count in enumerate(_levels(size)[:-1]):
        now = levels[-1]
        up = {}
        for run, places in _runs(list(now), count):
            for p in places:
                if p not in now:
                    now[p] = fetched[tree, level, p]
            up[run] = node([now[p] for p in places])
        levels.append(up)
    return levels


def _path(levels: list[dict[int, bytes]], size: int, pos: int
          ) -> list[tuple[list[bytes], list[bytes]]]:
    """Per level, the siblings left and right of the way up from ``pos``."""
    out = []
    for level, count in enumerate(_levels(size)[:-1]):
        first = pos - pos % FAN
        now = levels[level]
        out.append(([now[p] for p in range(first, pos)],
                    [now[p] for p in range(pos + 1, min(count, first + FAN))]))
        pos //= FAN
    return out


def fold(claim: bytes, path: list[tuple[list[bytes], list[bytes]]]) -> bytes:
    """The root that follows from a leaf and the siblings on its way up."""
    for left, right in path:
        claim = node([*left, claim, *right])
    return claim


def _expand(rows: pd.DataFrame, fetched: dict, n_groups: int) -> pd.DataFrame:
    """Siblings, subroot and folded root of every wanted leaf of one partition."""
    sub, levels = {}, {}
    for (tree, size), part in rows.groupby(["tree", "size"], sort=False):
        lowest = dict(zip(part["pos"].tolist(), part["leaf"].tolist()))
        levels[tree] = _tree_nodes(tree, size, lowest, fetched)
        sub[int(part["rank"].iloc[0])] = levels[tree][-1][0]
    top = _tree_nodes(TOP, n_groups, sub, fetched)
    # all leaves of a group share the way from the subroot up
    upper = {rank: _path(top, n_groups, rank) for rank in sub}
    siblings, subroots, folded = [], [], []
    for r in rows.itertuples(index=False):
        path = _path(levels[r.tree], r.size, r.pos) + upper[r.rank]
        siblings.append([d.hex() for left, right in path for d in (*left, *right)])
        subroots.append(sub[r.rank].hex())
        folded.append(fold(r.claim, path).hex())
    return pd.DataFrame({"g": rows["g"], "siblings": siblings, "subroot": subroots,
                         "folded_root": folded})


def prove(manifest: Manifest, wanted: DataFrame | None = None, claim: str = "leaf",
          partition: int = PARTITION) -> DataFrame:
    """A proof for every leaf of ``wanted`` (rows of ``manifest.leaves``; all of them by default).

    Returns g, id, leaf, claim, subroot, siblings (hex digests, level by level via the subroot to
    the root, left to right), folded_root (of the column ``claim``; of the leaf where that is null)
    and verified.
    """
    leaves = manifest.leaves if wanted is None else wanted
    n_groups = manifest.n_groups
    rows = leaves.select(F.floor(F.col("g") / partition).alias("_p"), "g", "id", "tree", "size",
                         "pos", "rank", "leaf", F.coalesce(claim, "leaf").alias("claim"))

    def coordinates(pdf: pd.DataFrame) -> pd.DataFrame:
        need = pd.DataFrame(missing(_wanted(pdf, n_groups)),
                            columns=["tree", "level", "pos"])
        return need.assign(_p=pdf["_p"].iloc[0])[["_p", "tree", "level", "pos"]]

    need = (rows.select("_p", "tree", "size", "pos", "rank").groupBy("_p")
            .applyInPandas(coordinates, "_p long, tree long, level int, pos long"))
    known = manifest.nodes.unionByName(manifest.leaves.select(
        "tree", F.lit(0).alias("level"), "pos", F.col("leaf").alias("digest")))
    fetched = need.join(known, ["tree", "level", "pos"])

    def expand(key, own: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        if own.empty:
            return pd.DataFrame([], columns=["g", "id", "leaf", "claim", "siblings", "subroot",
                                             "folded_root"])
        digests = dict(zip(zip(nodes["tree"], nodes["level"], nodes["pos"]), nodes["digest"]))
        proofs = _expand(own, digests, n_groups)
        return pd.concat([own[["g", "id"]], own["leaf"].map(bytes.hex).rename("leaf"),
                          own["claim"].map(bytes.hex).rename("claim"),
                          proofs[["siblings", "subroot", "folded_root"]]], axis=1)

    id_type = dict(leaves.dtypes)["id"]
    proofs = (rows.groupBy("_p").cogroup(fetched.groupBy("_p")).applyInPandas(
        expand, f"g long, id {id_type}, leaf string, claim string, siblings array<string>, "
                "subroot string, folded_root string"))
    return proofs.withColumn("verified", F.col("folded_root") == F.lit(manifest.root))


# --- the query and its SQL ----------------------------------------------------

def tampered(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text without line feeds where 2 divides the CRC-32 of the decimal id, else null."""
    even = F.crc32(F.col(id_col).cast("string").cast("binary")).bitwiseAND(1) == 0
    return F.when(even, F.translate(F.col(text_col), "\n", ""))


def manifest_of_documents(docs: DataFrame) -> Manifest:
    """The manifest whose ``claim`` is the leaf of the tampered text, where there is one."""
    altered = leaf(*[tampered() if f == "text" else F.col(f) for f in FIELDS])
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")).bitwiseAND(1) == 0
    return build(docs, keep={"claim": F.when(even, F.unhex(altered))})


def _framed_sql(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"


_LEAF_SQL = "sha256(" + " || ".join(_framed_sql(c) for c in FIELDS[:-1]) + " || {})"

ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, {_LEAF_SQL.format(_framed_sql('text'))} AS leaf,
         CASE WHEN {CRC32_SQL.format('doc_id::VARCHAR')} % 2 = 0
           THEN {_LEAF_SQL.format(_framed_sql("replace(text, chr(10), '')"))} END AS altered
  FROM documents),
p AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS size,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
  FROM d),
t AS (   -- the trees of the sources
  SELECT tree, 0 AS level, pos, leaf AS digest, size FROM p
  UNION ALL
  SELECT tree, level + 1, pos // {FAN}, sha256(string_agg(digest, '' ORDER BY pos)),
         (size + {FAN - 1}) // {FAN}
  FROM t WHERE size > 1 GROUP BY tree, level, pos // {FAN}, size),
s AS (SELECT tree, digest, count(*) OVER () AS n FROM t WHERE size = 1),
u AS (   -- the tree of the subroots
  SELECT 0 AS level, tree AS pos, digest, n AS size FROM s
  UNION ALL
  SELECT level + 1, pos // {FAN}, sha256(string_agg(digest, '' ORDER BY pos)),
         (size + {FAN - 1}) // {FAN}
  FROM u WHERE size > 1 GROUP BY level, pos // {FAN}, size),
nodes AS (   -- levels counted through the subroot up to the root
  SELECT tree, level, pos, digest, size FROM t
  UNION ALL SELECT NULL, level, pos, digest, size FROM u),
steps AS (   -- every leaf's own place on each level that has siblings
  SELECT p.doc_id, p.leaf, p.tree AS own, t.level, 0 AS upper, p.tree AS tree,
         (p.pos // pow({FAN}, t.level)::BIGINT) AS pos
  FROM p JOIN (SELECT DISTINCT tree, level FROM t WHERE size > 1) t USING (tree)
  UNION ALL
  SELECT p.doc_id, p.leaf, p.tree, u.level, 1, NULL, (p.tree // pow({FAN}, u.level)::BIGINT)
  FROM p CROSS JOIN (SELECT DISTINCT level FROM u WHERE size > 1) u),
sides AS (
  SELECT x.doc_id, x.leaf, x.upper, x.level,
         coalesce(string_agg(n.digest, '' ORDER BY n.pos) FILTER (WHERE n.pos < x.pos), '') AS l,
         coalesce(string_agg(n.digest, '' ORDER BY n.pos) FILTER (WHERE n.pos > x.pos), '') AS r,
         row_number() OVER (PARTITION BY x.doc_id, x.leaf ORDER BY x.upper, x.level) AS step
  FROM steps x LEFT JOIN nodes n ON n.tree IS NOT DISTINCT FROM x.tree AND n.level = x.level
    AND n.pos // {FAN} = x.pos // {FAN} AND n.pos <> x.pos
  GROUP BY x.doc_id, x.leaf, x.upper, x.level, x.pos),
proofs AS (
  SELECT doc_id, leaf, sha256(string_agg(l || r, '' ORDER BY step)) AS proof_sha256,
         max(step) AS steps FROM sides GROUP BY doc_id, leaf),
f AS (
  SELECT doc_id, leaf, 0 AS step, coalesce(altered, leaf) AS digest FROM p
  UNION ALL
  SELECT f.doc_id, f.leaf, f.step + 1, sha256(l || f.digest || r)
  FROM f JOIN sides ON sides.doc_id = f.doc_id AND sides.leaf = f.leaf
    AND sides.step = f.step + 1)
SELECT p.doc_id, p.leaf, s.digest AS subroot, root.digest AS root,
       coalesce(proof_sha256, sha256('')) AS proof_sha256, f.digest AS folded_root,
       f.digest = root.digest AS verified
FROM p JOIN s USING (tree) JOIN (SELECT digest FROM u WHERE size = 1) root ON true
LEFT JOIN proofs ON proofs.doc_id = p.doc_id AND proofs.leaf = p.leaf
JOIN f ON f.doc_id = p.doc_id AND f.leaf = p.leaf AND f.step = coalesce(steps, 0)
"""
