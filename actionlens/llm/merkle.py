"""Merkle tree over the rows of a table, with a proof for every row.

Leaves are numbered within their group by ranges. A level of the tree is one aggregate: the children
of a parent are spread over ``fanout`` slot columns, the concatenated columns hash to the parent, and
the columns other than a child's own are its siblings. Levels are taken in strides: rows are dealt by the block
of leaves under one node of the stride's top level, and the aggregates of all levels of the stride
run where the rows are. So a tree over n leaves takes ``log(n) / 8`` shuffles, of which every one
after the first moves a 256th of the rows of the one before. Groups of any size share the work: a
block, not a group, is what a task needs together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage

FANOUT = 2
# Leaves under one node at the top of a stride, at most.
BLOCK_LEAVES = 256
# Rows that are broadcast, at most; each holds a few numbers or one path of digests.
MOST_BROADCAST = 20_000

DIGEST_BITS = 256
_PATH = "array<struct<before:string,after:string>>"
_ALTERED_EVERY = 7


def field_text(column: Column) -> Column:
    """``-`` for null, else the value as text after its number of UTF-8 bytes and a colon."""
    text = column.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*columns: Column) -> Column:
    """Digest of a row's fields in the given order, as lowercase hex."""
    return F.sha2(F.concat(*map(field_text, columns)), DIGEST_BITS)


def siblings(path: Column) -> Column:
    """The digests beside a leaf on the way to the root, left to right, one level after the other."""
    return F.concat_ws("", F.transform(path, lambda step: F.concat(step["before"], step["after"])))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of ``path``."""
    return F.aggregate(path, leaf, lambda digest, step: F.sha2(F.concat(step["before"], digest, step["after"]), DIGEST_BITS))


def _by_group(left: DataFrame, right: DataFrame, on: list[str], small: bool) -> DataFrame:
    """Inner join that takes nulls as equal."""
    names = {c: f"_{c}" for c in on}
    right = right.withColumnsRenamed(names)
    met = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    condition = met[0]
    for one in met[1:]:
        condition &= one
    return left.join(F.broadcast(right) if small else right, condition).drop(*names.values())


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Stored ``rows(grp, ...)`` with ``pos``, the place within the group by ``order``, and ``n``, the
    rows of the group. Rows that tie, copies even, are spread over ranges like all others."""
    keys = [F.col(c).asc_nulls_first() for c in ("grp", *order)] + [F.col("_row")]
    placed = rows.withColumn("_row", F.monotonically_increasing_id())
    placed = cut_lineage(placed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row"))
    # Stored partitions keep their rows in order, and a group's rows in one partition follow each other.
    placed = placed.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33))
    group = Window.partitionBy("grp")
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each partition and group in it.
    runs = placed.groupBy("grp", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    runs = runs.select("grp", "_part", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"), F.sum("_rows").over(group).alias("n"))
    runs = cut_lineage(runs)
    joined = _by_group(placed, runs, ["grp", "_part"], runs.count() <= MOST_BROADCAST)
    return joined.withColumn("pos", F.col("_before") + F.col("_at") - F.col("_first")).drop("_at", "_first", "_before", "_part")


def _levels_per_stride(fanout: int) -> int:
    levels = 1
    while fanout ** (levels + 1) <= BLOCK_LEAVES:
        levels += 1
    return levels


def _lengthened(members: Column, step: Column) -> Column:
    return F.transform(members, lambda m: m.withField("path", F.concat(m["path"], F.array(step))))


def _stride(nodes: DataFrame, fanout: int) -> DataFrame:
    """``nodes(grp, pos, n, digest, members)`` some levels higher up. A node's ``members`` are the nodes that
    the stride began with, as ``(row, path)``. A group down to one node stays as it is."""
    levels = _levels_per_stride(fanout)
    nodes = nodes.withColumn("block", F.expr(f"pos div {fanout**levels}")).repartition("grp", "block")
    slots = [f"slot{s}" for s in range(fanout)]
    for _ in range(levels):
        child = F.struct("digest", "members")
        spread = [F.max(F.when(F.col("pos") % fanout == s, child)).alias(slots[s]) for s in range(fanout)]
        parents = nodes.groupBy("grp", "block", F.expr(f"pos div {fanout}").alias("pos"), "n").agg(*spread)
        digests = [F.col(slot)["digest"] for slot in slots]
        below = []
        for s, slot in enumerate(slots):
            step = F.struct(F.concat_ws("", *digests[:s]).alias("before"), F.concat_ws("", *digests[s + 1 :]).alias("after"))
            below.append(F.coalesce(_lengthened(F.col(slot)["members"], step), F.slice(F.col(slots[0])["members"], 1, 0)))
        many = F.col("n") > 1
        nodes = parents.select(
            "grp",
            "block",
            "pos",
            F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
            F.when(many, F.sha2(F.concat_ws("", *digests), DIGEST_BITS)).otherwise(digests[0]).alias("digest"),
            F.when(many, F.concat(*below)).otherwise(F.col(slots[0])["members"]).alias("members"),
        )
    return nodes.drop("block")


def _climb(leaves: DataFrame, fanout: int) -> list[DataFrame]:
    """The top nodes of every stride over ``leaves(grp, pos, n, digest, row)``, stored; the last ones
    are the roots of the groups."""
    empty = F.array().cast(_PATH).alias("path")
    strides = []
    nodes = leaves.select("grp", "pos", "n", "digest", F.array(F.struct("row", empty)).alias("members"))
    while True:
        tops = cut_lineage(_stride(nodes, fanout))
        strides.append(tops)
        if (tops.agg(F.max("n")).first()[0] or 0) <= 1:
            return strides
        nodes = tops.select("grp", "pos", "n", "digest", F.array(F.struct(F.col("pos").alias("row"), empty)).alias("members"))


def _descend(strides: list[DataFrame], carried: DataFrame) -> DataFrame:
    """``(row, path, ...)`` of every leaf, from ``carried(grp, pos, path, ...)`` of every group's root,
    whose further columns go along. A key of these joins has no more rows than a block."""
    more = [c for c in carried.columns if c not in ("grp", "pos", "path")]
    for tops in reversed(strides):
        small = carried.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
        joined = _by_group(tops.select("grp", "pos", "members"), carried, ["grp", "pos"], small)
        member = joined.select("grp", F.explode("members").alias("m"), "path", *more)
        down = member.select("grp", F.col("m.row").alias("pos"), F.concat("m.path", "path").alias("path"), *more)
        carried = down if tops is strides[0] else cut_lineage(down)
    return carried.drop("grp").withColumnRenamed("pos", "row")


def proofs(leaves: DataFrame, group: str, order: list[str], digest: str = "leaf", fanout: int = FANOUT) -> DataFrame:
    """Every row of ``leaves`` with ``path``, ``subroot`` and ``root``.

    The rows of each ``group`` make a tree in ascending ``order``, nulls first, then by ``digest``; rows that
    tie in both are interchangeable. Every ``fanout`` consecutive nodes have a parent, the last ones
    of a level may be fewer, until one is left: the subroot. Subroots by ascending group, null first, make a
    tree likewise, with the root on top. A group, or table, of one node is its own root. ``path`` has, from
    the leaf's level to the root's, the digests ``before`` and ``after`` the own one under the same
    parent, joined. Columns of ``leaves`` called like the new ones are left out. An empty table gives no
    rows. Runs jobs: leaves are stored, once in order, and the nodes of every stride.
    """
    if fanout < 2:
        raise ValueError("a parent has two children at least")
    kept = [c for c in leaves.columns if c not in ("path", "subroot", "root")]
    keys = [f"o{i}" for i in range(len(order))]
    nodes = leaves.select(F.col(group).alias("grp"), *(F.col(c).alias(k) for c, k in zip(order, keys)), F.col(digest).alias("digest"), F.struct(*kept).alias("row"))
    strides = _climb(_numbered(cut_lineage(nodes), [*keys, "digest"]), fanout)
    tops = strides[-1].select("grp", "digest")
    # The groups are the leaves of the upper tree, in a group of their own.
    upper = cut_lineage(tops.select(F.lit(0).alias("grp"), F.col("grp").alias("o0"), "digest", F.struct(F.col("grp").alias("of"), F.col("digest").alias("subroot")).alias("row")))
    upper_strides = _climb(_numbered(upper, ["o0"]), fanout)
    roots = upper_strides[-1].select("grp", "pos", F.array().cast(_PATH).alias("path"), F.col("digest").alias("root"))
    of_group = _descend(upper_strides, roots).select(F.col("row.of").alias("grp"), F.lit(0).cast("long").alias("pos"), "path", "row.subroot", "root")
    return _descend(strides, cut_lineage(of_group)).select("row.*", "path", "subroot", "root")


def document_leaves(documents: DataFrame) -> DataFrame:
    """``(doc_id, lang, leaf, altered)`` of every document. ``altered`` is the digest of the row with one more in
    ``n_chars``, for ids whose crc32 has a certain divisor, else null; a null ``n_chars`` stays null."""
    fields = [F.col("doc_id").cast("long"), F.col("source"), F.col("lang"), F.col("n_chars").cast("long"), F.col("text")]
    more = [*fields[:3], fields[3] + 1, fields[4]]
    chosen = F.crc32(fields[0].cast("string").cast("binary")) % _ALTERED_EVERY == 0
    return documents.select(fields[0].alias("doc_id"), "lang", leaf_digest(*fields).alias("leaf"), F.when(chosen, leaf_digest(*more)).alias("altered"))


def verified_manifest(documents: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` of every document.

    The proof is checked with the altered leaf where there is one. Null ids come first, rows of the same id
    stand by their digests; a null text, source, language or number is a field like any other.
    """
    proven = proofs(document_leaves(documents), "lang", ["doc_id"], fanout=fanout)
    folded = fold(F.coalesce("altered", "leaf"), F.col("path"))
    out = proven.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), DIGEST_BITS).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
