"""Merkle manifest of a table: every row is a leaf, each group (a language) has a
tree over its leaves in id order, and the groups' roots have a tree of their own.

A node is the SHA-256 of its children's digests written as hex; the last node of
a level goes up alone. The built levels are stored as node rows that link to
their parent. A stored row climbs ``RISE`` levels at once: it holds the node's
digest, its siblings on the way, and the link to the node where the way ends. A
recursive query then starts where the ways of a block of leaves end, appends the
siblings and follows the link, through the group's root to the root of the
manifest, so a tree over 10^11 leaves takes four steps. Every leaf row takes on
the siblings that its block has found and folds its presented leaf with its own
and these. So the recursion carries a row for 2**RISE leaves, and leaves are not
moved step by step.

Texts are hashed where they are read and never moved. Leaves are numbered by
range parts; blocks of 2**RISE neighbours are grouped, so a task holds one
block of digests, however large a group is. Rows that many blocks reach stand in
several copies, one for every ``LANE`` blocks of leaves below, and a block follows
its link to its own copy: no key of the climb's joins has more than some LANE rows,
and none of the join with the leaves more than 2**RISE.

Defined cases: a null field is written ``-``; a null group is a group, the first;
null ids come first; rows with one id are ordered by their leaf, so repeated rows
are neighbours with equal leaves; empty and very long texts are fields like any
other; an empty table gives no rows. Columns that are not fields are not read.
"""

from __future__ import annotations

import contextlib
import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadsplit.session import scratch_path

from .common import grouped, shuffle_partitions, stage
from .positions import number_rows

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RISE = 12
LANE = 1024
TOP = -1  # tree number of the tree over the groups' roots

#: a stored node: where it is, its digest, the digests beside the way up (side 0: none, 1: left, 2: right),
#: the node where the way ends with its digest and how many copies of its own row there are, how many
#: blocks of leaves start below the node and (in the first row of a block) below the end of the way, and how many leaves are below the tree's root
_NODE = "tree long, level int, pos long, hash binary, siblings array<struct<side: int, hash: binary>>, up_tree long, up_level int, " \
        "up_pos long, up_lanes long, up_hash binary, weight long, up_weight long, n long"
_SIBLINGS = pa.list_(pa.struct([("side", pa.int32()), ("hash", pa.binary())]))
#: what a leaf's row has besides
_LEAF = ("_id", "shown")


def field(c: Column) -> Column:
    """``-`` for null, else byte count, colon, value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    """Digest of a row, as bytes."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]), 256))


# --- levels -------------------------------------------------------------------------------

def _parent(*digests: bytes) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def _levels(leaves: list[bytes], rise: int) -> list[list[bytes]]:
    """The leaves of a block and ``rise`` levels above them."""
    levels = [leaves]
    for _ in range(rise):
        below = levels[-1]
        levels.append([_parent(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return levels


def _block_rows(batches: Iterator[pa.RecordBatch], level: int, rise: int) -> Iterator[pa.RecordBatch]:
    """Node rows of whole blocks, from rows (block, tree, pos, hash, weight, n and what
    a leaf has besides) sorted by block and place."""
    for rows in _blocks(batches):
        tree, n = rows["tree"][0].as_py(), rows["n"][0].as_py()
        depth = max(n - 1, 0).bit_length()           # levels above the tree's leaves
        up = min(level + rise, depth)
        pos, digests, weight = (rows[c].to_pylist() for c in ("pos", "hash", "weight"))
        levels = _levels(digests, up - level)
        ways = []
        for i in range(len(digests)):
            way = []
            for nodes in levels[:-1]:
                beside = i ^ 1
                way.append({"side": 0, "hash": None} if beside >= len(nodes) else {"side": 1 if beside < i else 2, "hash": nodes[beside]})
                i >>= 1
            ways.append(way)
        m, total = len(digests), sum(weight)
        link = (tree, up, pos[0] >> (up - level)) if up < depth else (None, None, None) if tree == TOP else (TOP, 0, tree)
        fixed = lambda value, kind: pa.array([value] * m, kind)
        own = {"tree": fixed(tree, pa.int64()), "level": fixed(level, pa.int32()), "pos": pa.array(pos, pa.int64()),
               "hash": pa.array(digests, pa.binary()), "siblings": pa.array(ways, _SIBLINGS), "up_tree": fixed(link[0], pa.int64()),
               "up_level": fixed(link[1], pa.int32()), "up_pos": fixed(link[2], pa.int64()), "up_lanes": fixed(-(-total // LANE), pa.int64()),
               "up_hash": fixed(levels[-1][0], pa.binary()), "weight": pa.array(weight, pa.int64()),
               "up_weight": pa.array([total] + [0] * (m - 1), pa.int64()), "n": fixed(n, pa.int64())}
        besides = [c for c in _LEAF if c in rows.column_names]
        yield pa.RecordBatch.from_arrays([*own.values(), *(rows[c].combine_chunks() for c in besides)], [*own, *besides])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """One table a block; a task has the blocks of several keys."""
    for rows in grouped(batches, "block"):
        key = rows["block"].to_pylist()
        cuts = [0, *(i for i in range(1, len(key)) if key[i] != key[i - 1]), len(key)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield rows.slice(a, b - a).combine_chunks()


def build_levels(leaves: DataFrame, most: int, path: str, rise: int = RISE) -> None:
    """Write the node rows of the trees over ``leaves`` (tree, pos, hash, weight, n and
    columns to keep with a leaf) to ``path/base=L``. ``n`` is the number of leaves of
    the row's tree, ``most`` the largest of them."""
    spark, level = leaves.sparkSession, 0
    schema = T._parse_datatype_string(_NODE)
    for c in leaves.columns:
        if c in _LEAF:
            schema = schema.add(c, leaves.schema[c].dataType)
    while True:
        block = F.concat_ws("/", F.col("tree").cast("string"), F.shiftright("pos", rise).cast("string"))
        dealt = leaves.withColumn("block", block).repartition(shuffle_partitions(spark), "block").sortWithinPartitions("block", "pos")
        dealt.mapInArrow(functools.partial(_block_rows, level=level, rise=rise), schema).write.parquet(f"{path}/base={level}")
        level += rise
        if level >= max(most - 1, 0).bit_length():
            return
        done = spark.read.parquet(f"{path}/base={level - rise}")
        leaves = done.where((F.col("up_level") == level) & (F.col("up_tree") == F.col("tree")) & (F.col("up_weight") > 0)) \
            .select("tree", F.col("up_pos").alias("pos"), F.col("up_hash").alias("hash"), F.col("up_weight").alias("weight"), "n")
        schema = T._parse_datatype_string(_NODE)


# --- the manifest -------------------------------------------------------------------------

def write_manifest(docs: DataFrame, path: str, presented: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS,
                   id_col: str = "doc_id", group_col: str = "lang", rise: int = RISE) -> None:
    """Write ``path/trees`` and ``path/top``, the node rows of the groups' trees and of
    the tree over their roots. A leaf's row also has ``_id`` and ``shown``, the leaf of
    the row with the columns of ``presented`` in place of its own: what
    ``prove`` holds against the tree."""
    spark = docs.sparkSession
    plain = {c: F.col(f"`{c}`") for c in fields}
    rows = docs.select(F.col(f"`{group_col}`").alias("_group"), F.col(f"`{id_col}`").alias("_id"),
                       leaf(list(plain.values())).alias("hash"), leaf(list((plain | (presented or {})).values())).alias("shown"))
    line = number_rows(rows, [F.col("_group").asc_nulls_first(), F.col("_id").asc_nulls_first(), F.col("hash")], "line")
    groups = line.groupBy(F.col("_group").alias("_g")).agg(F.min("line").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = stage(number_rows(groups, [F.col("_g").asc_nulls_first()], "tree"), "merkle-groups")
    n_groups, most = groups.agg(F.count(F.lit(1)), F.max("n")).first()
    leaves = line.join(groups, F.col("_group").eqNullSafe(F.col("_g"))) \
        .select("tree", (F.col("line") - F.col("first")).alias("pos"), "hash", "n", *_LEAF) \
        .withColumn("weight", (F.col("pos") % 2 ** rise == 0).cast("long"))  # the first of a block counts for it
    build_levels(leaves, most or 0, f"{path}/trees", rise)
    roots = _nodes(spark, f"{path}/trees").where((F.col("up_tree") == TOP) & (F.col("up_weight") > 0))
    build_levels(roots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.col("up_hash").alias("hash"),
                              F.col("up_weight").alias("weight"), F.lit(n_groups).cast("long").alias("n")), n_groups, f"{path}/top", rise)


def _nodes(spark: SparkSession, path: str) -> DataFrame:
    """Stored node rows of all levels, without what only leaves have."""
    return spark.read.schema(f"{_NODE}, base int").parquet(path)


def root_hash(spark: SparkSession, path: str) -> str | None:
    """Hex digest of the manifest's root; None for a manifest without rows."""
    found = _nodes(spark, f"{path}/top").where("up_tree is null and up_weight > 0").select(F.lower(F.hex("up_hash"))).first()
    return found and found[0]


_FOLD = """aggregate({siblings}, {start}, (h, s) -> sha2(CASE s.side WHEN 0 THEN h WHEN 1 THEN concat(lower(hex(s.hash)), h)
                                                       ELSE concat(h, lower(hex(s.hash))) END, 256))"""
_APPEND = "aggregate({siblings}, {start}, (p, s) -> concat(p, coalesce(s.hash, X'')))"

_CLIMB = f"""
WITH RECURSIVE climb AS (
  SELECT up_tree AS tree, up_level AS level, up_pos AS pos, CAST(array() AS array<struct<side: int, hash: binary>>) AS way,
         up_tree, up_level, up_pos, up_lanes, up_hash, IF(up_tree = {TOP}, up_hash, NULL) AS subroot
  FROM {{start}}
  UNION ALL
  SELECT c.tree, c.level, c.pos, concat(c.way, r.siblings),
         r.up_tree, r.up_level, r.up_pos, r.up_lanes, r.up_hash, coalesce(c.subroot, IF(r.up_tree = {TOP}, r.up_hash, NULL))
  FROM climb c JOIN {{nodes}} r
    ON r.tree = c.up_tree AND r.level = c.up_level AND r.pos = c.up_pos
   AND r.lane = pmod(c.pos + c.tree, c.up_lanes))
SELECT tree, level, pos, way, lower(hex(subroot)) AS subroot, lower(hex(up_hash)) AS root
FROM climb WHERE up_tree IS NULL"""

_PROVE = f"""
SELECT _id, leaf, subroot, root, proof, folded AS folded_root, folded = root AS verified
FROM (SELECT _id, leaf, subroot, root, {_APPEND.format(siblings="siblings", start="X''")} AS proof,
             {_FOLD.format(siblings="siblings", start="shown")} AS folded
      FROM (SELECT l._id, lower(hex(l.hash)) AS leaf, lower(hex(l.shown)) AS shown, concat(l.siblings, w.way) AS siblings, w.subroot, w.root
            FROM {{leaves}} l JOIN {{ways}} w ON w.tree = l.up_tree AND w.level = l.up_level AND w.pos = l.up_pos))"""


@contextlib.contextmanager
def _unlimited_recursion(spark: SparkSession) -> Iterator[None]:
    """No limit on the rows of a recursive query: it has some per block of leaves."""
    key = "spark.sql.cteRecursionRowLimit"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def climb(spark: SparkSession, path: str) -> DataFrame:
    """Climb from every block of leaves of the manifest at ``path``: the node where the
    ways of its leaves end (tree, level, pos), the siblings from there to the root
    (way), subroot and root (hex)."""
    upper = _nodes(spark, f"{path}/trees").where("base > 0").unionByName(_nodes(spark, f"{path}/top"))
    # a row stands once for each lane of the blocks below it, as its children's link counts them
    lanes = F.sequence(F.lit(0).cast("long"), F.ceil(F.col("weight") / LANE) - 1)
    nodes = upper.withColumn("lane", F.explode(lanes)).drop("base", "weight", "up_weight", "n", "hash")
    with _unlimited_recursion(spark):
        start = spark.read.parquet(f"{path}/trees/base=0").where("up_weight > 0")
        return stage(spark.sql(_CLIMB, start=start, nodes=nodes), "merkle-ways")


def prove(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Way of every leaf of the manifest at ``path``: id, leaf, subroot, root
    (hex), proof (the siblings' digests, left to right from the leaf up), folded_root
    (what the presented leaf gives) and verified."""
    leaves = spark.read.parquet(f"{path}/trees/base=0")
    return spark.sql(_PROVE, leaves=leaves, ways=climb(spark, path)).withColumnRenamed("_id", id_col)


def manifest(docs: DataFrame, presented: dict[str, Column] | None = None, **options) -> DataFrame:
    """``write_manifest`` to the scratch folder, then ``prove``."""
    path = scratch_path(docs.sparkSession, "merkle-manifest")
    write_manifest(docs, path, presented, **options)
    return prove(docs.sparkSession, path, options.get("id_col", "doc_id"))
