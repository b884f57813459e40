"""A Merkle manifest of a dataset: a content-addressed DAG of digests, proofs by descent from its root.

Leaves are digests of rows. The leaves of a source, in order of their ids, are joined three by three, level by level, to one
subroot; the subroots in order of their sources likewise give the root. Each inner node is a record ``digest -> children``.
A proof is found from the root down: a request for leaf ``r`` follows the digits of ``r`` to base three, collects the
children it does not choose, and reverses what it has collected.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm.ranks import ranked
from cartwright.session import shared_dir

#: Children of an inner node; the last of a level may have fewer.
WIDTH = 3
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest_of(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, joined."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value; so no two rows give one string."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(**changed: Column) -> Column:
    """The digest of a row, of ``changed`` values where given."""
    return digest_of(*(field(changed.get(name, F.col(name))) for name in FIELDS))


@dataclass(frozen=True)
class Tree:
    """Nodes by level. ``levels[0]`` are leaves (owner, rank, n, digest); ``levels[k]`` are records, which have
    ``children`` too; ``n`` is the number of nodes an owner has on that level."""

    levels: list[DataFrame]

    def tops(self) -> DataFrame:
        """``owner, height, digest``: what remains of each owner's leaves."""
        found = [
            nodes.where("n = 1").select("owner", F.lit(k).alias("height"), "digest") for k, nodes in enumerate(self.levels)
        ]
        out = found[0]
        for one in found[1:]:
            out = out.unionByName(one)
        return out


def grow(leaves: DataFrame, folder: str) -> Tree:
    """The trees over ``leaves`` (owner, rank, n, digest), one level of records after the other, each a written table.

    A level groups by (owner, rank / 3), at most three rows to a group, and is a third of the one below it. Owners with one node
    are done. The driver sees the largest ``n``, which gives the number of levels.
    """
    spark, levels = leaves.sparkSession, [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        run = F.array_sort(F.collect_list(F.struct("rank", "digest")))
        wide = levels[-1].where("n > 1").groupBy("owner", F.expr(f"rank div {WIDTH}").alias("rank"))
        joined = wide.agg(F.first("n").alias("n"), F.transform(run, lambda x: x["digest"]).alias("children"))
        path = f"{folder}/level-{len(levels)}"
        joined.select(
            "owner",
            "rank",
            F.expr(f"(n + {WIDTH - 1}) div {WIDTH}").alias("n"),
            digest_of(F.concat_ws("", "children")).alias("digest"),
            "children",
        ).write.parquet(path)
        levels.append(spark.read.parquet(path))
        most = -(-most // WIDTH)
    return Tree(levels)


def descend(tree: Tree, starts: DataFrame, keep: list[str], wanted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """From ``starts`` (owner, height, digest, path, and columns to ``keep``) down to the lowest records.

    Returns what was reached without any step (owner, path, kept: trees of one leaf), and the lowest records as
    (owner, rank, children, path, kept). A path holds per step, root first, the unselected children left and right
    of the chosen one. Requests that share a node share its row, so all of them together send a third of the leaves'
    number on the last step, a ninth on the step before it. Records are looked up by digest, equal ones once.
    ``wanted`` (owner, rank of leaf) leaves out the nodes above no wanted leaf.
    """
    here = None
    for k in range(len(tree.levels) - 1, 0, -1):
        begun = starts.where(F.col("height") == k).select("owner", zero("rank"), "digest", "path", *keep)
        here = begun if here is None else here.unionByName(begun)
        if wanted is not None:
            needed = wanted.select("owner", F.expr(f"rank div {WIDTH**k}").alias("rank")).distinct()
            here = here.join(needed, ["owner", "rank"], "left_semi")
        records = tree.levels[k].select("digest", "children").dropDuplicates(["digest"])
        here = here.join(records, "digest").select("owner", "rank", "children", "path", *keep)
        if k > 1:
            here = stepped(here, keep)
    if here is None:
        here = starts.where("false").select("owner", zero("rank"), F.array("digest").alias("children"), "path", *keep)
    return starts.where("height = 0").select("owner", "path", *keep), here


def stepped(here: DataFrame, keep: list[str]) -> DataFrame:
    """One row per child of each record, with its rank and its path."""
    chosen = here.select("*", F.posexplode("children").alias("digit", "digest"))
    rank = (F.col("rank") * WIDTH + F.col("digit")).alias("rank")
    return chosen.select("owner", rank, "digest", longer(F.col("digit")).alias("path"), *keep)


def longer(digit: Column) -> Column:
    """``path`` with the step to the child at ``digit`` added."""
    left = F.concat_ws("", F.slice("children", F.lit(1), digit.cast("int")))
    right = F.concat_ws("", F.slice("children", digit.cast("int") + 2, F.lit(WIDTH)))
    return F.concat("path", F.array(F.struct(left.alias("left"), right.alias("right"))))


def zero(name: str) -> Column:
    return F.lit(0).cast("long").alias(name)


def no_step() -> Column:
    return F.expr("cast(array() as array<struct<left: string, right: string>>)").alias("path")


@dataclass(frozen=True)
class Manifest:
    """``rows``: owner, rank, digest and what the caller keeps of each row; ``sources``: source, owner, subroot, height.
    ``trees`` are over the rows, ``top`` is over the subroots."""

    rows: DataFrame
    sources: DataFrame
    trees: Tree
    top: Tree

    def root(self) -> DataFrame:
        """One row with ``root``; none for an empty table."""
        return self.top.tops().select(F.col("digest").alias("root"))


def new_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/merkle-{uuid.uuid4().hex}"


def build(leaves: DataFrame, folder: str) -> Manifest:
    """The manifest of ``leaves`` (source, doc_id, digest, and columns to keep), written below ``folder``.

    Within a source, leaves ascend by doc_id, null first, then by digest. Sources ascend by their UTF-8 bytes, null first.
    Leaves are written before they are ranked, so that long texts are read and hashed once.
    """
    spark = leaves.sparkSession
    leaves.write.parquet(f"{folder}/leaves")
    rows = ranked(spark.read.parquet(f"{folder}/leaves"), "source", ["doc_id", "digest"], f"{folder}/ranked")
    rows.write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    trees = grow(rows.select("owner", "rank", "n", "digest"), f"{folder}/trees")
    named = rows.where("rank = 0").select("source", "owner")
    tops = trees.tops().withColumnRenamed("digest", "subroot")
    named.join(tops, "owner").write.parquet(f"{folder}/sources")
    sources = spark.read.parquet(f"{folder}/sources")
    number = F.lit(sources.count())
    base = sources.select(zero("owner"), F.col("owner").alias("rank"), number.alias("n"), F.col("subroot").alias("digest"))
    return Manifest(rows, sources, trees, grow(base, f"{folder}/top"))


def proofs(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """The manifest's rows with ``subroot``, ``root`` and ``path``, the leaf's siblings level by level, leaf first, as (left, right).

    ``requests`` (owner, rank) asks for some rows only; by default all are asked for.
    """
    rows, wanted, owners = manifest.rows, None, None
    if requests is not None:
        wanted = requests.select("owner", "rank").distinct()
        owners = wanted.select(zero("owner"), F.col("owner").alias("rank")).distinct()
        rows = rows.join(wanted, ["owner", "rank"], "left_semi")
    root = manifest.top.tops().select("owner", "height", "digest", no_step(), F.col("digest").alias("root"))
    lone, lowest = descend(manifest.top, root, ["root"], owners)
    slots = stepped(lowest, ["root"]).select(F.col("rank").alias("owner"), "path", "root")
    starts = lone.unionByName(slots).join(manifest.sources.drop("source"), "owner")
    if wanted is not None:
        starts = starts.join(wanted.select("owner").distinct(), "owner", "left_semi")
    kept = ["root", "subroot"]
    lone, lowest = descend(manifest.trees, starts.withColumn("digest", F.col("subroot")), kept, wanted)
    # The last step meets each row with its parent, so that a path is sent once for three leaves.
    bare = lone.select("owner", zero("parent"), F.array().cast("array<string>").alias("children"), "path", *kept)
    parents = bare.unionByName(lowest.withColumnRenamed("rank", "parent"))
    met = rows.withColumn("parent", F.expr(f"rank div {WIDTH}")).join(parents, ["owner", "parent"])
    whole = F.when(F.size("children") > 0, longer(F.col("rank") % WIDTH)).otherwise(F.col("path"))
    return met.withColumn("path", F.reverse(whole)).drop("children", "parent")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda at, step: digest_of(step["left"], at, step["right"]))


def proof_digest(path: Column) -> Column:
    """One digest of all siblings, leaf level first, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda x: F.concat(x["left"], x["right"]))), 256)


def verified(docs: DataFrame, received: Column, folder: str | None = None) -> DataFrame:
    """The manifest of ``docs``, and for each row whether the text ``received`` in place of its own still folds to the root.

    Null is a value (written as ``-``) in any column; rows that repeat are leaves each. An empty table has no root and gives no rows. Columns
    other than those of ``documents`` take no part and may have any name.
    """
    leaves = docs.select("source", "doc_id", leaf_of().alias("digest"), leaf_of(text=received).alias("met"))
    manifest = build(leaves, folder or new_folder(docs.sparkSession))
    found = proofs(manifest).withColumn("folded_root", folded(F.col("met"), F.col("path")))
    return found.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def tampered_text() -> Column:
    """The text without its line feeds where 2 divides the id's CRC-32, else as it is; a null id is left alone."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
