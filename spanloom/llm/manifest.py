"""A Merkle manifest of a table: digests of rows, of groups of rows, and of all of it.

Every row is a leaf. The leaves of a group, in order, are hashed pairwise until one node
remains, its subroot (a last node without a partner is hashed alone); the subroots, in the
order of their groups, are hashed likewise to the root.

A tree is stored as aligned subtrees of ``HEIGHT`` levels of hashing. The nodes of a subtree
stand in van Emde Boas order: the upper half of its levels first, then each tree below it, every
one laid out in the same way, so a path from a leaf to the root of a subtree touches few runs of
neighbouring bytes at any size of a run. ``addresses`` computes the places; construction and
the retrieval of siblings go through it. The roots of the subtrees are the leaves of the next
layer, which is built by the same code, until each group has one subtree.

Ranks come from a range sort, and a subtree is built by the task that gets its 1,024 leaves, so a group
that holds most rows is as good as many small ones. Proofs go down from the last layer: a
subtree hands to each of its leaves the siblings inside it and those above its own root.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from spanloom.operators.skew import join_sized, ranged_row_number
from spanloom.staging import stage

#: Levels of hashing inside a stored subtree, which has two to this power of leaves.
HEIGHT = 10
#: What a leaf is made of, in this order, and what its group is.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
GROUP = "lang"
DIGEST_BYTES = 32
#: Documents with this share of checksums are tampered with in the report.
TAMPERED = 7


# ---- one subtree ----------------------------------------------------------------------------


@functools.lru_cache(maxsize=64)
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """For each depth of a full binary tree the place of its nodes, left to right.

    The tree is cut at half its levels; the upper tree comes first, then the lower ones in order.
    """
    if levels == 1:
        return (np.zeros(1, dtype=np.int64),)
    upper, lower = addresses(levels // 2), addresses(levels - levels // 2)
    above, size = (1 << len(upper)) - 1, (1 << len(lower)) - 1
    return upper + tuple(
        (above + size * np.arange(1 << len(upper))[:, None] + places[None, :]).ravel()
        for places in lower
    )


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


@dataclass(frozen=True)
class Subtree:
    """``leaves`` digests and the levels of hashing above them, as bytes in layout order."""

    height: int
    leaves: int
    nodes: bytes

    @staticmethod
    def build(leaves: list[str], height: int) -> "Subtree":
        places = [p.tolist() for p in addresses(height + 1)]
        nodes = [""] * ((2 << height) - 1)
        for place, leaf in zip(places[height], leaves):
            nodes[place] = leaf
        width = len(leaves)
        for depth in range(height - 1, -1, -1):
            width, below, here = (width + 1) // 2, places[depth + 1], places[depth]
            for i in range(width):
                nodes[here[i]] = digest(nodes[below[2 * i]], nodes[below[2 * i + 1]])
        absent = "0" * (2 * DIGEST_BYTES)
        return Subtree(height, len(leaves), bytes.fromhex("".join(n or absent for n in nodes)))

    def _node(self, place: int) -> str:
        return self.nodes[DIGEST_BYTES * place : DIGEST_BYTES * (place + 1)].hex()

    @property
    def root(self) -> str:
        return self._node(0)

    def siblings(self, leaf: int) -> list[str]:
        """What each level from the leaf up is hashed with: L or R and the sibling, or N."""
        out, width = [], self.leaves
        for places in addresses(self.height + 1)[:0:-1]:
            other = leaf ^ 1
            if other < width:
                out.append(("L" if leaf & 1 else "R") + self._node(int(places[other])))
            else:
                out.append("N")
            leaf, width = leaf >> 1, (width + 1) // 2
        return out


def fold(node: str, siblings: list[str]) -> str:
    """The root that a node and its siblings give."""
    for one in siblings:
        node = digest(one[1:], node) if one[0] == "L" else digest(node, one[1:])
    return node


# ---- the layers of a forest -----------------------------------------------------------------


def _height(nodes: int, height: int) -> int:
    """Levels of hashing in a subtree when its group has so many nodes in this layer."""
    return min(height, (nodes - 1).bit_length())


_LAYER = "grp string, block bigint, size bigint, height int, leaves int, nodes binary, root string"


def _build_layer(nodes: DataFrame, height: int, name: str) -> DataFrame:
    """Subtrees of (grp, place, digest, size): every aligned run of nodes of a group."""

    def build(key, rows):
        rows = rows.sort_values("place")
        size = int(rows["size"].iloc[0])
        tree = Subtree.build(rows["digest"].tolist(), _height(size, height))
        one = (key[0], key[1], size, tree.height, tree.leaves, tree.nodes, tree.root)
        return pd.DataFrame([one], columns=[f.split()[0] for f in _LAYER.split(", ")])

    block = F.shiftright("place", height).alias("block")
    return stage(
        nodes.select("grp", "place", "digest", "size").groupBy("grp", block)
        .applyInPandas(build, _LAYER),
        name,
    )


@dataclass(frozen=True)
class Forest:
    """Layers of subtrees, the lowest first; in the last every group has one."""

    height: int
    layers: list[DataFrame]

    def roots(self) -> DataFrame:
        """grp, root."""
        return self.layers[-1].select("grp", "root")

    def paths(self, above: DataFrame, name: str) -> DataFrame:
        """grp, block, path of the subtrees of the lowest layer: the siblings above their roots.

        ``above`` has (grp, path): the siblings above the roots of the groups.
        """
        found = above.withColumn("block", F.lit(0).cast("bigint"))
        for k, layer in reversed(list(enumerate(self.layers[1:]))):
            found = stage(_descend(layer.join(found, ["grp", "block"]), self.height), f"{name}-{k}")
        return found


def _descend(trees: DataFrame, height: int) -> DataFrame:
    """grp, block, path of the layer below: what each leaf of a subtree is hashed with."""

    def expand(key, rows):
        out = []
        for row in rows.itertuples():
            tree = Subtree(row.height, row.leaves, row.nodes)
            first = key[1] << height
            out += [
                (key[0], first + i, "".join(s + ";" for s in tree.siblings(i)) + row.path)
                for i in range(tree.leaves)
            ]
        return pd.DataFrame(out, columns=["grp", "block", "path"])

    return (
        trees.select("grp", "block", "height", "leaves", "nodes", "path").groupBy("grp", "block")
        .applyInPandas(expand, "grp string, block bigint, path string")
    )


def build_forest(leaves: DataFrame, height: int = HEIGHT, name: str = "merkle") -> Forest:
    """The trees of (grp, place, digest, size): places count from 0 inside a group of ``size``."""
    layers = [_build_layer(leaves, height, f"{name}-0")]
    # The largest group halves its nodes ``height`` times per layer.
    most = layers[0].agg(F.max("size")).first()[0] or 0
    while most > 1 << height:
        most = -(-most >> height)
        nodes = layers[-1].select(
            "grp", F.col("block").alias("place"), F.col("root").alias("digest"),
            F.expr(f"(size + {(1 << height) - 1}) div {1 << height}").alias("size"),
        )
        layers.append(_build_layer(nodes, height, f"{name}-{len(layers)}"))
    return Forest(height, layers)


# ---- the manifest of a table ----------------------------------------------------------------


def field_text(value: Column) -> Column:
    """``-`` for null, else the length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf_digest(fields: dict[str, Column] | tuple[str, ...]) -> Column:
    """The digest of a row from its fields in order."""
    columns = fields.values() if isinstance(fields, dict) else map(F.col, fields)
    return F.sha2(F.concat(*map(field_text, columns)), 256)


def group_key(column: str) -> Column:
    """Groups in their order as text that is never null: null first, then by the bytes."""
    value = F.col(column).cast("string")
    return F.when(value.isNull(), "").otherwise(F.concat(F.lit(":"), value))


@dataclass(frozen=True)
class Manifest:
    """The leaves (grp, place, size, id, digest, claim), their forest, and that of the subroots."""

    leaves: DataFrame
    forest: Forest
    top: Forest
    places: DataFrame

    @property
    def root(self) -> str | None:
        """The digest of the whole table; null without rows."""
        row = self.top.roots().first()
        return row.root if row else None


def build_manifest(
    rows: DataFrame, claim: Column | None = None, fields: tuple[str, ...] = FIELDS,
    group: str = GROUP, row_id: str = "doc_id", height: int = HEIGHT,
) -> Manifest:
    """The manifest of a table: leaves ascend by ``row_id`` inside each group.

    ``claim`` is the digest that somebody claims for a row, null where nobody does. Null ids come
    first; rows of one id are ordered by their digest, so the manifest does not depend on how the table
    is stored. Null fields are hashed as such. Texts of any length count whole, repeated rows are
    leaves each, other columns do not count, and a table without rows has no root.
    """
    claimed = F.lit(None).cast("string") if claim is None else claim
    hashed = rows.select(
        group_key(group).alias("grp"), F.col(row_id).alias("id"),
        leaf_digest(fields).alias("digest"), claimed.alias("claim"),
    )
    ranked = ranged_row_number(hashed, "grp", ["id", "digest"], "number").select(
        "grp", (F.col("number") - 1).alias("place"), F.col("id").cast("string").alias("id"),
        "digest", "claim",
    )
    sizes = ranked.groupBy("grp").agg(F.count("*").alias("size"))
    leaves = stage(join_sized(ranked, sizes, "grp", "size"), "merkle-placed")
    forest = build_forest(leaves, height)
    subroots = stage(forest.roots().withColumn("_all", F.lit("")), "merkle-subroots")
    places = ranged_row_number(subroots, "_all", ["grp"], "number")
    places = stage(
        places.select("grp", F.col("root").alias("digest"), (F.col("number") - 1).alias("place")),
        "merkle-groups",
    )
    top = build_forest(
        places.select(F.lit("").alias("grp"), "place", "digest", F.lit(places.count()).alias("size")),
        height, "merkle-top",
    )
    return Manifest(leaves, forest, top, places)


_PROVED = (
    "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
)


def prove(manifest: Manifest) -> DataFrame:
    """id as text, leaf, subroot, root, the digest of the proof, and the root folded from the claim.

    Where there is no claim the leaf itself is folded.
    """
    height = manifest.forest.height
    none = manifest.top.roots().select("grp", F.lit("").alias("path"))
    tops = manifest.top.paths(none, "merkle-top-paths")
    trees = manifest.top.layers[0].join(tops.withColumnRenamed("path", "above"), ["grp", "block"])
    groups = _descend(trees.withColumnRenamed("above", "path"), height)  # a path per group
    groups = stage(groups.withColumnRenamed("block", "place").drop("grp"), "merkle-group-paths")
    above = manifest.places.join(groups, "place").select(
        "grp", "path", F.col("digest").alias("subroot")
    )
    above = stage(above, "merkle-above")
    paths = manifest.forest.paths(above.select("grp", "path"), "merkle-paths")
    root = manifest.root
    trees = (
        manifest.forest.layers[0].select("grp", "block", "height", "leaves", "nodes")
        .join(paths, ["grp", "block"])
    )
    leaves = manifest.leaves.withColumn("block", F.shiftright("place", height))

    def fold_rows(key, rows, tree):
        one = tree.iloc[0]
        subtree = Subtree(int(one["height"]), int(one["leaves"]), one["nodes"])
        rest = [s for s in one["path"].split(";") if s]
        first = int(key[1]) << height
        # The path of a leaf passes the subroot after the levels of its group.
        inside = (int(rows["size"].iloc[0]) - 1).bit_length()
        out = []
        for place, row_id, leaf, claim in zip(
            rows["place"], rows["id"], rows["digest"], rows["claim"]
        ):
            path = subtree.siblings(int(place) - first) + rest
            subroot = fold(leaf, path[:inside])
            if isinstance(claim, str):
                folded = fold(claim, path)
            else:
                folded = fold(subroot, path[inside:])
            proof = digest(*(s[1:] for s in path))
            out.append((row_id, leaf, subroot, root, proof, folded))
        return pd.DataFrame(
            out, columns=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
        )

    return (
        leaves.select("grp", "block", "place", "size", "id", "digest", "claim")
        .groupBy("grp", "block").cogroup(trees.groupBy("grp", "block"))
        .applyInPandas(fold_rows, _PROVED)
    )


def audit(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Every document with its digests, and whether its proof holds after some were altered.

    Where ``TAMPERED`` divides the CRC-32 of the doc_id, the row that is proved has one more in
    n_chars, if that is not null; a null doc_id is never altered.
    """
    altered = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    fields = {f: F.col(f) for f in FIELDS} | {"n_chars": F.col("n_chars") + 1}
    rows = docs.select(*FIELDS)
    manifest = build_manifest(
        rows, F.when(altered & F.col("n_chars").isNotNull(), leaf_digest(fields)), height=height
    )
    return prove(manifest).select(
        F.col("id").cast("bigint").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256",
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _sql_field(column: str, value: str | None = None) -> str:
    text = f"cast({value or column} as varchar)"
    return f"case when {column} is null then '-' else strlen({text}) || ':' || {text} end"


_SQL_LEAF = "sha256(" + " || ".join(map(_sql_field, FIELDS)) + ")"
_SQL_CLAIM = _SQL_LEAF.replace(_sql_field("n_chars"), _sql_field("n_chars", "n_chars + 1"))

ORACLE = f"""
with recursive crc_bytes as (
  select b, list_reduce(list_prepend(b, range(8)),
    lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
  from range(256) r(b)),
crc_table as (select list(v order by b) as t from crc_bytes),
hashed as (
  select doc_id, case when lang is null then '' else ':' || lang end as grp, {_SQL_LEAF} as leaf,
    case when n_chars is not null and xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(
          range(1, strlen(cast(doc_id as varchar)) + 1),
          lambda i: cast(ascii(substr(cast(doc_id as varchar), i, 1)) as bigint))),
        lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) % {TAMPERED} = 0
      then {_SQL_CLAIM} end as claim
  from documents, crc_table),
placed as (
  select *, row_number() over (partition by grp order by doc_id nulls first, leaf) - 1 as place,
    count(*) over (partition by grp) as size, row_number() over () as uid from hashed),
nodes as (
  select grp, 0 as lvl, place, size as n, leaf as h from placed
  union all
  select grp, lvl + 1, place // 2, (n + 1) // 2, sha256(string_agg(h, '' order by place))
  from nodes where n > 1 group by grp, lvl, place // 2, n),
subroots as (
  select grp, h as subroot, row_number() over (order by grp) - 1 as place, count(*) over () as n
  from nodes where n = 1),
tops as (
  select 0 as lvl, place, n, subroot as h from subroots
  union all
  select lvl + 1, place // 2, (n + 1) // 2, sha256(string_agg(h, '' order by place))
  from tops where n > 1 group by lvl, place // 2, n),
found as (
  select p.uid, v.lvl, (p.place >> v.lvl) & 1 as odd, coalesce(s.h, '') as h
  from placed p join (select distinct grp, lvl from nodes where n > 1) v on v.grp = p.grp
  left join nodes s on s.grp = p.grp and s.lvl = v.lvl and s.place = xor(p.place >> v.lvl, 1)
  union all
  select p.uid, 100 + v.lvl, (g.place >> v.lvl) & 1, coalesce(s.h, '')
  from placed p join subroots g on g.grp = p.grp cross join (select distinct lvl from tops where n > 1) v
  left join tops s on s.lvl = v.lvl and s.place = xor(g.place >> v.lvl, 1)),
siblings as (select *, row_number() over (partition by uid order by lvl) as k from found),
folds as (
  select uid, 0 as k, coalesce(claim, leaf) as h from placed
  union all
  select f.uid, s.k, sha256(case when s.odd = 1 then s.h || f.h else f.h || s.h end)
  from folds f join siblings s on s.uid = f.uid and s.k = f.k + 1),
folded as (select uid, arg_max(h, k) as folded_root from folds group by uid),
proofs as (select uid, sha256(string_agg(h, '' order by k)) as proof from siblings group by uid)
select p.doc_id, p.leaf, g.subroot, r.h as root, coalesce(q.proof, sha256('')) as proof_sha256,
  f.folded_root, f.folded_root = r.h as verified
from placed p join subroots g on g.grp = p.grp join folded f on f.uid = p.uid
left join proofs q on q.uid = p.uid cross join (select h from tops where n = 1) r"""
