"""Operator 12: a Merkle manifest of a dataset by cogrouped subtree exchange.

Rows are the leaves of one tree per group; the groups' roots are the leaves of one more tree, whose
root stands for the whole dataset. A tree's nodes are cut into superblocks of 8^4. On the way up every
superblock is reduced to one node, and the nodes of all superblocks are the next round's leaves, so
four levels take one shuffle. On the way down the nodes of a superblock are cogrouped with the one
row that has the outer nodes of its path: the group's reduction is finished there once more, its own
siblings are joined to the outer ones, and proofs and folded roots come out of the same call. A task
holds one superblock at a time, whatever the size of a group.

Positions come from a range shuffle by (group, id, digest) that is written before it is counted: the
row's number within its partition plus the rows of its group in the partitions before.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.base import query, table
from plumbline.session import reliable_checkpoint

ARITY = 8
#: Levels that one superblock spans.
SPAN = 4
BLOCK = ARITY**SPAN

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def depth_of(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    depth = 0
    while n > 1:
        n, depth = -(-n // ARITY), depth + 1
    return depth


def reduce_block(digests: list[str], levels: int) -> list[list[str]]:
    """The nodes of a block level by level, its own nodes first; runs start at the block's first node."""
    out = [digests]
    for _ in range(levels):
        last = out[-1]
        out.append([sha("".join(last[i : i + ARITY])) for i in range(0, len(last), ARITY)])
    return out


def siblings(levels: list[list[str]], at: int) -> tuple[list[str], list[str]]:
    """Digests left and right of a node within its run, for every level but the last."""
    lefts, rights = [], []
    for nodes in levels[:-1]:
        first = at - at % ARITY
        lefts.append("".join(nodes[first:at]))
        rights.append("".join(nodes[at + 1 : first + ARITY]))
        at //= ARITY
    return lefts, rights


def fold(digest: str, lefts: list[str], rights: list[str]) -> str:
    """The root over a node, from its siblings."""
    for left, right in zip(lefts, rights):
        digest = sha(left + digest + right)
    return digest


def field(column: Column) -> Column:
    """A field of a leaf: ``-`` if null, else its length in bytes, a colon and its text."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*columns: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (grp, ...) with pos, their place along ``order`` within grp, and n, the rows of grp.

    ``seq`` of ``rows`` tells equal rows apart, so they can lie in different ranges.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, "grp", *order, "seq").sortWithinPartitions("grp", *order, "seq")
    placed = reliable_checkpoint(ranged.drop("seq").withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    runs = placed.groupBy("grp", part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("c"))
    within = Window.partitionBy("grp")
    before = F.sum("c").over(within.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("grp", "part", "first", F.coalesce(before, F.lit(0)).alias("shift"), F.sum("c").over(within).alias("n"))
    found = placed.withColumn("part", part).join(runs, ["grp", "part"])
    return found.withColumn("pos", F.col("at") - F.col("first") + F.col("shift")).drop("at", "part", "first", "shift")


def _block() -> Column:
    return F.floor(F.col("pos") / BLOCK).cast("bigint").alias("block")


def climb(nodes: DataFrame) -> list[DataFrame]:
    """Rounds of (grp, pos, n, digest): the given nodes, then the nodes of their superblocks, until one node a group is left."""

    def up(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        n = int(group["n"].iloc[0])
        top = reduce_block(group.sort_values("pos")["digest"].tolist(), min(SPAN, depth_of(n)))[-1]
        return pd.DataFrame({"grp": [key[0]], "pos": [key[1]], "n": [-(-n // BLOCK)], "digest": [top[0]]})

    rounds = [nodes]
    while (most := rounds[-1].agg(F.max("n")).first()[0]) is not None and most > 1:
        blocks = rounds[-1].select("grp", "pos", "n", "digest", _block()).groupBy("grp", "block")
        rounds.append(reliable_checkpoint(blocks.applyInPandas(up, "grp string, pos bigint, n bigint, digest string")))
    return rounds


def descend(nodes: DataFrame, outer: DataFrame) -> DataFrame:
    """(grp, pos, lefts, rights, subroot, root) of every node; ``outer`` has the same of its superblocks' nodes."""

    def down(key: tuple, group: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        if group.empty or above.empty:
            return pd.DataFrame(columns=["grp", "pos", "lefts", "rights", "subroot", "root"], dtype=object)
        group = group.sort_values("pos")
        levels = reduce_block(group["digest"].tolist(), min(SPAN, depth_of(int(group["n"].iloc[0]))))
        over = above.iloc[0]
        own = [siblings(levels, i) for i in range(len(group))]
        return pd.DataFrame({
            "grp": key[0], "pos": group["pos"], "lefts": [x + list(over["lefts"]) for x, _ in own],
            "rights": [x + list(over["rights"]) for _, x in own], "subroot": over["subroot"], "root": over["root"],
        })

    schema = "grp string, pos bigint, lefts array<string>, rights array<string>, subroot string, root string"
    blocks = nodes.select("grp", "pos", "n", "digest", _block()).groupBy("grp", "block")
    return blocks.cogroup(outer.withColumnRenamed("pos", "block").groupBy("grp", "block")).applyInPandas(down, schema)


def prove(leaves: DataFrame, outer: DataFrame) -> DataFrame:
    """Leaves with their proof and the root folded from ``shown``, the digest that is presented for them."""

    def down(key: tuple, group: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        if group.empty or above.empty:
            return pd.DataFrame(columns=["id", "leaf", "subroot", "root", "proof", "folded_root"], dtype=object)
        group = group.sort_values("pos")
        levels = reduce_block(group["digest"].tolist(), min(SPAN, depth_of(int(group["n"].iloc[0]))))
        over = above.iloc[0]
        proofs, roots = [], []
        for i, shown in enumerate(group["shown"]):
            lefts, rights = siblings(levels, i)
            lefts, rights = lefts + list(over["lefts"]), rights + list(over["rights"])
            proofs.append([a + b for a, b in zip(lefts, rights)])
            roots.append(fold(shown, lefts, rights))
        return pd.DataFrame({"id": group["id"], "leaf": group["digest"], "subroot": over["subroot"], "root": over["root"], "proof": proofs, "folded_root": roots})

    schema = "id string, leaf string, subroot string, root string, proof array<string>, folded_root string"
    blocks = leaves.select("grp", "pos", "n", "id", "digest", "shown", _block()).groupBy("grp", "block")
    return blocks.cogroup(outer.withColumnRenamed("pos", "block").groupBy("grp", "block")).applyInPandas(down, schema)


def _paths(rounds: list[DataFrame], outer: DataFrame) -> DataFrame:
    """``outer`` of the last round's nodes taken down to the superblocks of the first."""
    for nodes in reversed(rounds[1:]):
        outer = reliable_checkpoint(descend(nodes, outer))
    return outer


def manifest(rows: DataFrame, id_column: str, group_column: str, leaf: Column, shown: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, proof, folded_root and verified of every row.

    ``leaf`` is a row's digest in the tree, ``shown`` the one presented later; ``proof`` has the digests
    of its siblings, one string a level. Leaves of a group ascend by id, null first; rows of one id by
    their digest, so equal rows are leaves of their own side by side. The null group is a group and comes
    first; groups ascend bytewise. A group, or a dataset, of one row has that row's digest as its root
    and an empty proof. An empty table gives no rows. Other columns are ignored.
    """
    named = F.when(F.col(group_column).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(group_column).cast("string")))
    leaves = rows.select(
        named.alias("grp"), F.col(id_column).alias("id"), leaf.alias("digest"), shown.alias("shown"), F.monotonically_increasing_id().alias("seq"))
    leaves = numbered(reliable_checkpoint(leaves), ["id", "digest"]).withColumn("id", F.col("id").cast("string"))
    leaves = reliable_checkpoint(leaves)
    trees = climb(leaves)

    tops = trees[-1].select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest", F.lit(0).alias("seq"))
    tops = reliable_checkpoint(numbered(reliable_checkpoint(tops), ["name"]))
    whole = climb(tops)
    none = F.array().cast("array<string>")
    root = whole[-1].select("grp", "pos", none.alias("lefts"), none.alias("rights"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    # One step more than within a group: the tops themselves get their paths, and become what lies above the groups.
    if len(whole) > 1:
        root = descend(tops, _paths(whole, root))
    named_tops = tops.select("pos", "name", F.col("digest").alias("top"))
    above = root.select("pos", "lefts", "rights", "root").join(named_tops, "pos").select(
        F.col("name").alias("grp"), F.lit(0).cast("bigint").alias("pos"), "lefts", "rights", F.col("top").alias("subroot"), "root")
    # Without a second round a group's only node is its leaf, which is block 0 as well.
    proved = prove(leaves, _paths(trees, reliable_checkpoint(above)))
    kind = rows.schema[id_column].dataType
    return proved.select(
        F.col("id").cast(kind).alias("doc_id"), "leaf", "subroot", "root", "proof", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def tampered_documents(docs: DataFrame) -> tuple[Column, Column]:
    """Leaf of a document, and of what is shown later: where 3 divides crc32 of its id, the text is in lower case."""
    plain = leaf_of(*[F.col(c) for c in FIELDS])
    lowered = leaf_of(*[F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in FIELDS])
    return plain, F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lowered).otherwise(plain)


def _op12_sql(levels: int = 6) -> str:
    """DuckDB SQL of op12, level by level, for groups of up to 8^levels rows."""

    def tree(name: str, source: str, keys: str, order: str) -> str:
        on = lambda a, b: " AND ".join([f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys.split(", ") if k] or ["TRUE"])
        part = f"PARTITION BY {keys}" if keys else ""
        lead = f"{keys}, " if keys else ""
        steps = [f"{name}_0 AS (SELECT *, row_number() OVER ({part} ORDER BY {order}) - 1 AS pos, count(*) OVER ({part}) AS n FROM {source})"]
        for i in range(levels):
            grouping = f"GROUP BY {lead}n, pos // 8"
            steps.append(
                f"{name}_{i + 1} AS (SELECT {lead}pos // 8 AS pos, (n + 7) // 8 AS n, CASE WHEN n > 1 THEN sha256(string_agg(digest, '' ORDER BY pos)) "
                f"ELSE min(digest) END AS digest FROM {name}_{i} {grouping})")
            steps.append(
                f"{name}_s{i} AS (SELECT {', '.join(f'a.{k}' for k in keys.split(', ') if k) + ', ' if keys else ''}a.pos, "
                f"coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r, "
                f"any_value(a.n) AS n FROM {name}_{i} a JOIN {name}_{i} b ON {on('a', 'b')} AND a.pos // 8 = b.pos // 8 "
                f"GROUP BY {', '.join(f'a.{k}' for k in keys.split(', ') if k) + ', ' if keys else ''}a.pos)")
        return ", ".join(steps)

    def walked(name: str, keys: str, source: str, start: str) -> str:
        """proof and folded digest of the rows of ``source`` (pos0, proof, folded) through a tree."""
        steps, last = [], source
        for i in range(levels):
            on = " AND ".join([f"w.{k} IS NOT DISTINCT FROM s.{k}" for k in keys.split(", ") if k] + [f"w.{start} // {8 ** i} = s.pos"])
            steps.append(
                f"{name}_w{i} AS (SELECT w.* EXCLUDE (proof, folded), CASE WHEN s.n > 1 THEN w.proof || s.l || s.r ELSE w.proof END AS proof, "
                f"CASE WHEN s.n > 1 THEN sha256(s.l || w.folded || s.r) ELSE w.folded END AS folded FROM {last} w JOIN {name}_s{i} s ON {on})")
            last = f"{name}_w{i}"
        return ", ".join(steps)

    part = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
    leaf = lambda text: "sha256(" + " || ".join(part(text if c == "text" else c) for c in FIELDS) + ")"
    bits = "flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: list_transform(range(8), lambda i: (ascii(c) >> i) & 1)))"
    crc = f"xor(list_reduce(list_prepend(4294967295, {bits}), lambda c, b: CASE WHEN xor(c, b) & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295)"
    return (
        f"WITH leaves AS (SELECT doc_id, lang, {leaf('text')} AS digest, CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 "
        f"THEN {leaf(f'''translate(text, '{UPPER}', '{LOWER}')''')} ELSE {leaf('text')} END AS shown FROM documents), "
        + tree("t", "leaves", "lang", "doc_id NULLS FIRST, digest") + ", "
        f"tops AS (SELECT lang, digest FROM t_{levels}), " + tree("g", "tops", "", "lang NULLS FIRST") + ", "
        f"begun AS (SELECT t_0.doc_id, t_0.lang, t_0.digest AS leaf, t_0.pos AS lpos, g_0.pos AS gpos, g_0.digest AS subroot, '' AS proof, t_0.shown AS folded "
        f"FROM t_0 JOIN g_0 ON t_0.lang IS NOT DISTINCT FROM g_0.lang), "
        + walked("t", "lang", "begun", "lpos") + ", " + walked("g", "", f"t_w{levels - 1}", "gpos") + " "
        f"SELECT doc_id, leaf, subroot, r.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.digest AS verified "
        f"FROM g_w{levels - 1}, g_{levels} r")


@query("op12_subtree_manifest", _op12_sql())
def op12_subtree_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, proofs and folded roots of all documents, a tree per language."""
    docs = table(spark, sf_dir, "documents")
    plain, shown = tampered_documents(docs)
    out = manifest(docs, "doc_id", "lang", plain, shown)
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"), "folded_root", "verified")
