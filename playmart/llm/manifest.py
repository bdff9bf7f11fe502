"""Merkle manifest of a table: one digest for all rows, and a proof for every row.

Rows are leaves. Within a group they stand in order, every FANOUT consecutive nodes
become one node of the next level, until one is left, the group's subroot. The subroots,
in the order of their groups, become the root in the same way.

A level is one aggregation by parent: conditional aggregates put a node into the column
of its slot, so that the concatenated columns are what the parent hashes, and the
columns without a node's own slot are its siblings. Going up, a level is a FANOUT-th of
the one below. Going down, every parent hands its path to its children, so only the
lowest level meets as many rows as the table has, and no task holds more than a parent.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.llm.common import documents
from playmart.operators import Scratch
from playmart.operators.lookup import broadcast_within
from playmart.operators.numbering import dense_ids

FANOUT = 16
#: A row whose unsigned crc32 of the decimal id is divisible by this is tampered with.
TAMPER_EVERY = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PATH = "array<struct<left:string,right:string>>"


def field_bytes(value: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, a colon and the value."""
    value = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field_bytes(v) for v in values]), 256)


def _slots(fanout: int) -> list[str]:
    return [f"c{k}" for k in range(fanout)]


def _pivot(nodes: DataFrame, key: str, child: Column, fanout: int) -> DataFrame:
    """One row per parent: its place, the number of nodes on its children's level, and
    its children in one column per slot."""
    slot = F.col("pos") % fanout
    spread = [F.max(F.when(slot == k, child)).alias(name) for k, name in enumerate(_slots(fanout))]
    parent = F.expr(f"pos div {fanout}").alias("parent")
    return nodes.groupBy(key, "n", parent).agg(*spread)


def _joined(digests: list[Column]) -> Column:
    return F.concat_ws("", *digests) if digests else F.lit("")


def _climb(nodes: DataFrame, key: str, scratch: Scratch, label: str, fanout: int) -> list[DataFrame]:
    """The levels above ``nodes`` (key, pos, n, node), lowest first, as written tables
    of parents with their children's digests in the slot columns and their own, ``node``.

    The first level has every group, even one of a single node, whose parent is that
    node itself; the others have those groups only that have several nodes left.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels: list[DataFrame] = []
    while not levels or most > 1:
        child = F.struct("node", "row") if not levels and "row" in nodes.columns else F.struct("node")
        parents = _pivot(nodes, key, child, fanout)
        digests = [F.col(f"{c}.node") for c in _slots(fanout)]
        whole = F.when(F.col("n") == 1, F.col("c0.node")).otherwise(F.sha2(_joined(digests), 256))
        levels.append(scratch.write(f"{label}{len(levels)}", parents.withColumn("node", whole)))
        above = F.expr(f"(n + {fanout - 1}) div {fanout}")
        nodes = levels[-1].filter("n > 1").select(key, F.col("parent").alias("pos"), above.alias("n"), "node")
        nodes, most = nodes.filter("n > 1"), -(-most // fanout)
    return levels


def _children(parents: DataFrame, carried: list[str], fanout: int) -> DataFrame:
    """One row per child of parents that have a ``path``: the carried columns, the child
    (``child``), its place (``pos``) and its path. A parent of a group of one node is
    that node."""
    slots = _slots(fanout)
    digests = [F.col(f"{c}.node") for c in slots]
    each = []
    for k, c in enumerate(slots):
        pair = F.struct(_joined(digests[:k]).alias("left"), _joined(digests[k + 1 :]).alias("right"))
        each.append(F.struct(F.lit(k).alias("slot"), F.col(c).alias("child"), pair.alias("pair")))
    exploded = parents.select(*carried, "parent", "n", "path", F.explode(F.array(*each)).alias("e"))
    step = F.when(F.col("n") == 1, F.col("path")).otherwise(F.concat(F.array("e.pair"), F.col("path")))
    place = F.col("parent") * fanout + F.col("e.slot")
    present = exploded.filter(F.col("e.child.node").isNotNull())
    return present.select(*carried, place.alias("pos"), F.col("e.child").alias("child"), step.alias("path"))


def _descend(levels: list[DataFrame], tops: DataFrame, key: str, scratch: Scratch, label: str, fanout: int) -> DataFrame:
    """The children of the lowest level with their paths, given the path of every
    group's top and other columns of groups that are handed down with it."""
    carried = [c for c in tops.columns if c != "path"]
    below: DataFrame | None = None
    for number in reversed(range(len(levels))):
        parents = levels[number]
        known = parents.filter(F.col("n") <= fanout).join(tops, key)
        if below is not None:
            paths = below.withColumnRenamed("pos", "parent")
            known = known.unionByName(parents.filter(F.col("n") > fanout).join(paths, [key, "parent"]))
        below = _children(known, carried, fanout)
        if number:
            below = scratch.write(f"{label}-paths{number}", below.select(*carried, "pos", "path"))
    return below


def _subroots(levels: list[DataFrame], key: str, fanout: int) -> DataFrame:
    tops = [t.filter(F.col("n") <= fanout).select(key, F.col("node").alias("subroot")) for t in levels]
    return reduce(DataFrame.unionByName, tops)


def merkle_manifest(
    docs: DataFrame,
    scratch: Scratch,
    fields: tuple[str, ...] = FIELDS,
    group: str = "source",
    order: str = "doc_id",
    tampered: dict[str, Column] | None = None,
    fanout: int = FANOUT,
) -> DataFrame:
    """For every row its leaf, its group's subroot, the root, a digest of its proof, the
    root recomputed from that proof, and whether both roots are equal.

    A leaf hashes the given fields. Groups are the values of ``group``, null first, then
    by UTF-8 bytes; rows stand in them by ``order``, null first, rows of one order by
    leaf, so that repeated rows get a leaf and a proof each. ``tampered`` maps fields to
    what a later reader finds in them: recomputation starts from those values.

    Nulls are fields of their own, empty texts have length 0, texts are hashed whole. An
    empty table gives no rows. Other columns are passed over.
    """
    changed = tampered or {}
    found = leaf([F.coalesce(changed[f], F.col(f)) if f in changed else F.col(f) for f in fields])
    group_key = F.when(F.col(group).isNull(), "-").otherwise(F.concat(F.lit(":"), F.col(group).cast("string")))
    leaves = docs.select(
        F.col(group).cast("string").alias("group_value"),
        F.col(order).alias("row_order"),
        leaf([F.col(f) for f in fields]).alias("node"),
        found.alias("found"),
        group_key.alias("group_key"),
    )
    placed = dense_ids(leaves, "place", scratch)
    groups = placed.groupBy("group_key").agg(F.min("place").alias("first_place"), F.count(F.lit(1)).alias("n"))
    groups = broadcast_within(scratch.write("groups", groups))
    row = F.struct("group_value", "row_order", "found")
    nodes = placed.join(groups, "group_key").select(
        "group_key", (F.col("place") - F.col("first_place")).alias("pos"), "n", "node", row.alias("row")
    )
    levels = _climb(scratch.write("nodes", nodes), "group_key", scratch, "level", fanout)

    # The key of null is "-", which is less than the ":" before every value.
    ordered = scratch.write("subroots", dense_ids(_subroots(levels, "group_key", fanout), "pos", scratch))
    trees = ordered.select(
        F.lit(0).alias("tree"),
        "pos",
        F.lit(ordered.count()).cast("bigint").alias("n"),
        F.col("subroot").alias("node"),
        F.struct("group_key").alias("row"),
    )
    upper = _climb(trees, "tree", scratch, "upper", fanout)
    root = _subroots(upper, "tree", fanout).withColumn("path", F.array().cast(PATH))
    trees = _descend(upper, scratch.write("root", root.withColumnRenamed("subroot", "root")), "tree", scratch, "upper", fanout)
    tops = trees.select("child.row.group_key", F.col("child.node").alias("subroot"), "root", "path")
    rows = _descend(levels, scratch.write("tops", tops), "group_key", scratch, "level", fanout)

    siblings = F.transform("path", lambda p: F.concat(p["left"], p["right"]))
    folded = F.aggregate("path", F.col("child.row.found"), lambda node, p: F.sha2(F.concat(p["left"], node, p["right"]), 256))
    return rows.select(
        F.col("child.row.group_value").alias(group),
        F.col("child.row.row_order").alias(order),
        F.col("child.node").alias("leaf"),
        "subroot",
        "root",
        F.sha2(F.concat_ws("", siblings), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, checked against texts of which some lost their capitals."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    tampered = F.when(hit, F.translate("text", UPPER, LOWER))
    manifest = merkle_manifest(documents(spark, sf_dir), Scratch(spark, "manifest"), tampered={"text": tampered})
    return manifest.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR END"
_LEAF = " || ".join(_FIELD.format(f) for f in FIELDS[:-1])
OP12_SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(b, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS crcs
  FROM range(256) r(b)
),
hit AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) % {TAMPER_EVERY} = 0 AS tampered
  FROM documents, crc_table
),
hashed AS (
  SELECT doc_id, source, sha256({_LEAF} || {_FIELD.format("text")}) AS leaf,
    sha256({_LEAF} || {_FIELD.format("(CASE WHEN tampered THEN translate(text, '" + UPPER + "', '" + LOWER + "') ELSE text END)")}) AS found
  FROM hit
),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM hashed
),
levels(lvl, source, pos, n, node) AS (
  SELECT 0, source, pos, n, leaf FROM leaves
  UNION ALL
  SELECT lvl + 1, source, pos // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(node, '' ORDER BY pos))
  FROM levels WHERE n > 1 GROUP BY lvl, source, pos // {FANOUT}, n
),
subroots AS (
  SELECT source, lvl AS height, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM levels WHERE n = 1
),
upper(lvl, pos, n, node) AS (
  SELECT 0, pos, n, node FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(node, '' ORDER BY pos))
  FROM upper WHERE n > 1 GROUP BY lvl, pos // {FANOUT}, n
),
pairs AS (
  SELECT false AS top, lvl, source, pos,
    coalesce(string_agg(node, '') OVER (PARTITION BY lvl, source, pos // {FANOUT} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(node, '') OVER (PARTITION BY lvl, source, pos // {FANOUT} ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM levels WHERE n > 1
  UNION ALL
  SELECT true, lvl, NULL, pos,
    coalesce(string_agg(node, '') OVER (PARTITION BY lvl, pos // {FANOUT} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''),
    coalesce(string_agg(node, '') OVER (PARTITION BY lvl, pos // {FANOUT} ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '')
  FROM upper WHERE n > 1
),
paths AS (
  SELECT a.source, a.pos, p.lvl AS step, l, r FROM leaves a JOIN pairs p
    ON NOT top AND p.source IS NOT DISTINCT FROM a.source AND p.pos = a.pos // (16 ** p.lvl)::BIGINT
  UNION ALL
  SELECT a.source, a.pos, s.height + p.lvl, l, r FROM leaves a
  JOIN subroots s ON s.source IS NOT DISTINCT FROM a.source JOIN pairs p ON top AND p.pos = s.pos // (16 ** p.lvl)::BIGINT
),
proofs AS (
  SELECT source, pos, list(struct_pack(l := l, r := r) ORDER BY step) AS path, sha256(string_agg(l || r, '' ORDER BY step)) AS proof
  FROM paths GROUP BY source, pos
),
folded AS (
  SELECT a.doc_id, a.leaf, s.node AS subroot, (SELECT node FROM upper WHERE n = 1) AS root, coalesce(proof, sha256('')) AS proof_sha256,
    CASE WHEN path IS NULL THEN found ELSE list_reduce(list_prepend(struct_pack(l := found, r := ''), path),
      lambda x, y: struct_pack(l := sha256(y.l || x.l || y.r), r := '')).l END AS folded_root
  FROM leaves a JOIN subroots s ON s.source IS NOT DISTINCT FROM a.source
  LEFT JOIN proofs p ON p.source IS NOT DISTINCT FROM a.source AND p.pos = a.pos
)
SELECT *, folded_root = root AS verified FROM folded
"""
