"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf; each language has a binary tree over its leaves in order of their ids, and a last tree over the
languages' roots gives the manifest's root. A node is visited when its label (level, place) is due, and sends its digest
forward to its parent's label; a sweep in reversed order sends each child what remains of its proof. The queue that holds
the messages is external: messages that leave a band of ``2 ** BAND`` leaves below one node are exchanged and sorted by
Spark on the label of the block that they are addressed to; inside a block, a heap of at most two messages a node
delivers them. No task holds more than a block, however large a language is, and a tree of n leaves takes about
``log2(n) / BAND`` exchanges in each direction.
"""

from __future__ import annotations

import hashlib
import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowguard.llm.common import cut, read_table
from flowguard.operators.joins import bounded_broadcast

#: Levels of a band: a block has at most 2 ** BAND nodes of its lowest level.
BAND = 12
NO_SIBLING = "-"
MESSAGES = "tree string, levels int, place long, digest string, suffix string, root string"


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(columns: list[Column]) -> Column:
    """sha256 (lowercase hex) of the columns: ``-`` for null, else its UTF-8 byte count, a colon and its text."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")), F.lit(":"), c.cast("string")), F.lit("-"))
             for c in columns]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def tree_key(name: Column) -> Column:
    """Names of trees as text without null, in the order null, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), name), F.lit("-"))


def in_places(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with ``tree`` and ``order``) with their ``place`` (from 0) in the tree and its ``levels``.

    One range exchange sorts all trees together, so a tree may spread over any number of tasks; rows that tie on the whole
    order are parted by their position in the written input. Places are a row's number in its task plus what earlier
    tasks hold of the tree, a table of one row for each task and tree.
    """
    rows = rows.withColumn("_at", F.monotonically_increasing_id())
    keys = ["tree", *order, "_at"]
    rows = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_at")
               .withColumn("_m", F.monotonically_increasing_id()))
    task = F.shiftright("_m", 33)
    held = rows.groupBy("tree", task.alias("_task")).agg(F.min("_m").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("tree").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    held = cut(held.select("tree", "_task", "_first", F.coalesce(before, F.lit(0)).alias("_before"),
                           F.sum("_n").over(Window.partitionBy("tree")).alias("_size")))
    out = rows.withColumn("_task", task).join(bounded_broadcast(held), ["tree", "_task"])
    levels = F.length(F.bin(F.col("_size") - 1)).cast("int")
    return out.select("tree", F.when(F.col("_size") == 1, F.lit(0)).otherwise(levels).alias("levels"),
                      (F.col("_m") - F.col("_first") + F.col("_before")).alias("place"),
                      *[c for c in rows.columns if c not in ("tree", "_m")])


def swept_up(places: list[int], digests: list[str], levels: int) -> dict[tuple[int, int], str]:
    """Digests of all nodes (level, place) up to ``levels`` above the given run of places.

    The queue delivers a node's messages together when its label is the least one left, children in order.
    """
    nodes: dict[tuple[int, int], str] = {}
    queue = [((0, p), 0, d) for p, d in zip(places, digests, strict=True)]
    heapq.heapify(queue)
    while queue:
        label, _, digest = heapq.heappop(queue)
        if label[0]:
            while queue and queue[0][0] == label:
                digest += heapq.heappop(queue)[2]
            digest = digest_of(digest)
        nodes[label] = digest
        if label[0] < levels:
            heapq.heappush(queue, ((label[0] + 1, label[1] >> 1), label[1] & 1, digest))
    return nodes


def swept_down(nodes: dict[tuple[int, int], str], levels: int, suffix: str) -> dict[int, str]:
    """The rest of the proof at each place of the lowest level: what lies beside the path, from there up to the root.

    A level is ``L`` or ``R`` with the digest of the sibling on that side, or ``-`` for a node without one. The reversed
    sweep takes labels from the top; a parent sends its suffix, longer by the sibling's digest, to each child.
    """
    out: dict[int, str] = {}
    queue = [(-levels, -place, suffix) for level, place in nodes if level == levels]
    heapq.heapify(queue)
    while queue:
        level, place, rest = heapq.heappop(queue)
        level, place = -level, -place
        if level == 0:
            out[place] = rest
            continue
        left, right = nodes[level - 1, 2 * place], nodes.get((level - 1, 2 * place + 1))
        if right is None:
            heapq.heappush(queue, (1 - level, -2 * place, NO_SIBLING + rest))
        else:
            heapq.heappush(queue, (1 - level, -2 * place, "R" + right + rest))
            heapq.heappush(queue, (1 - level, -2 * place - 1, "L" + left + rest))
    return out


def siblings(suffix: str) -> list[tuple[str, str]]:
    """(side, digest) of the levels of a proof; the digest is empty where there is no sibling."""
    out, at = [], 0
    while at < len(suffix):
        side = suffix[at]
        at += 1
        digest = "" if side == NO_SIBLING else suffix[at:at + 64]
        at += len(digest)
        out.append((side, digest))
    return out


def folded(digest: str, suffix: str) -> str:
    """The root that a leaf's digest and its proof lead to."""
    for side, other in siblings(suffix):
        digest = digest_of(other + digest if side == "L" else digest + other)
    return digest


def proof_digest(suffix: str) -> str:
    return digest_of("".join(digest for _, digest in siblings(suffix)))


def _bands_up(nodes: DataFrame) -> list[DataFrame]:
    """Tables of (tree, levels, place, digest): the given nodes, then the roots of their blocks, band after band, until
    every tree has one node. ``levels`` counts what is left above."""
    bands = [nodes.select("tree", "levels", "place", "digest")]

    def up(key, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("place")
        rise = min(int(block["levels"].iloc[0]), BAND)
        place = int(block["place"].iloc[0]) >> rise
        root = swept_up(block["place"].tolist(), block["digest"].tolist(), rise)[rise, place]
        return pd.DataFrame({"tree": [key[0]], "levels": [int(block["levels"].iloc[0]) - rise], "place": [place],
                             "digest": [root]})

    while (bands[-1].agg(F.max("levels")).first()[0] or 0) > 0:
        block = F.shiftright("place", BAND).alias("block")
        bands.append(cut(bands[-1].groupBy("tree", block).applyInPandas(
            up, "tree string, levels int, place long, digest string")))
    return bands


def _band_down(nodes: DataFrame, above: DataFrame, finish=None, schema: str = MESSAGES) -> DataFrame:
    """``nodes`` with their proof suffixes and root, from those of the band above (tree, place, suffix, root): messages
    addressed to the blocks that ``above`` names, sorted to them together with the blocks' nodes.

    ``finish`` turns a block's nodes, with all their columns, into rows of ``schema``.
    """
    def down(block: pd.DataFrame) -> pd.DataFrame:
        message = block["suffix"].notna()
        suffix, root = block.loc[message, ["suffix", "root"]].iloc[0]
        own = block[~message].astype({"place": "int64", "levels": "int64"}).sort_values("place").reset_index(drop=True)
        rise = min(int(own["levels"].iloc[0]), BAND)
        rest = swept_down(swept_up(own["place"].tolist(), own["digest"].tolist(), rise), rise, suffix)
        own = own.assign(suffix=own["place"].map(rest), root=root)
        return finish(own) if finish else own[["tree", "levels", "place", "digest", "suffix", "root"]]

    own = nodes.withColumn("block", F.shiftright("place", BAND))
    sent = above.select("tree", F.col("place").alias("block"), "suffix", "root")
    return own.unionByName(sent, allowMissingColumns=True).groupBy("tree", "block").applyInPandas(down, schema)


class Manifest:
    """Trees over ``leaves`` (tree, digest and other columns) in the order of the named columns, then of the digests.

    ``placed``: the leaves with their places; ``subroots`` (name, digest): a row for each tree. The subroots are leaves
    of a last tree, in the order of the trees' names. No leaves give no rows.
    """

    def __init__(self, leaves: DataFrame, order: list[str]):
        self.placed = in_places(leaves, [*order, "digest"])
        self.bands = _bands_up(self.placed)
        self.subroots = cut(self.bands[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"))
        top = cut(in_places(self.subroots, ["name"]))
        bands = _bands_up(top)
        sent = bands[-1].select("tree", "place", F.lit("").alias("suffix"), F.col("digest").alias("root"))
        for nodes in reversed(bands[:-1]):
            sent = cut(_band_down(nodes, sent))
        sent = (top.select("place", "name").join(sent.select("place", "suffix", "root"), "place")
                .select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("place"), "suffix", "root"))
        for nodes in reversed(self.bands[1:-1]):
            sent = cut(_band_down(nodes, sent))
        self.sent = sent

    def proofs(self) -> DataFrame:
        """(tree, levels, place, digest, suffix, root) of every leaf."""
        return _band_down(self.bands[0], self.sent)

    def checked(self) -> DataFrame:
        """Every leaf with the sha256 of its proof, and the root that its column ``claimed`` and its proof lead to."""
        keep = [c for c in self.placed.columns if c not in ("levels", "place")]

        def finish(own: pd.DataFrame) -> pd.DataFrame:
            own["proof_sha256"] = own["suffix"].map(proof_digest)
            own["folded_root"] = [folded(c, s) for c, s in zip(own["claimed"], own["suffix"], strict=True)]
            return own[[*keep, "root", "proof_sha256", "folded_root"]]

        shape = ", ".join(f"`{c}` {self.placed.schema[c].dataType.simpleString()}" for c in keep)
        return _band_down(self.placed, self.sent, finish,
                          shape + ", root string, proof_sha256 string, folded_root string")


def manifest(df: DataFrame, doc_id: str, lang: str, digest: Column, claimed: Column) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row: its place in the manifest, and
    whether ``claimed``, the digest of the row as someone has it now, leads to the root along the row's proof.

    A null language is a tree of its own (the first); null ids come first in their tree, and equal ids are in order of
    their digests, so repeated rows are several leaves with proofs of their own. Empty and very long texts are hashed
    whole, natively. An empty table gives no rows. Other columns of ``df`` play no part.
    """
    shape = df.schema[doc_id].dataType.simpleString()
    leaves = cut(df.select(tree_key(F.col(lang)).alias("tree"), F.col(doc_id).alias("_id"), digest.alias("digest"),
                           claimed.alias("claimed"), F.col(doc_id).cast("string").alias("doc_id")))
    trees = Manifest(leaves, ["_id"])
    # ids travel as text, so that pandas leaves null ids alone
    trees.placed = trees.placed.drop("_id")
    names = trees.subroots.select(F.col("name").alias("tree"), F.col("digest").alias("subroot"))
    return trees.checked().join(bounded_broadcast(names), "tree").select(
        F.col("doc_id").cast(shape).alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256",
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of ``documents``, checked against a copy in which some rows' n_chars is larger by one.

    Rows are tampered with where 7 divides the crc32 of the id as text (a null id: never; a null n_chars stays).
    """
    docs = read_table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    more = [c if i != 3 else c.cast("decimal(20,0)") + F.lit(1).cast("decimal(1,0)") for i, c in enumerate(fields)]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    leaf = leaf_digest(fields)
    return manifest(docs, "doc_id", "lang", leaf, F.when(tampered, leaf_digest(more)).otherwise(leaf))


def _field(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


#: The trees level by level: a recursive step hashes each pair of neighbours; every leaf then meets its sibling on every
#: level, and its path is folded in the order of the levels.
OP13_SQL = f"""
WITH RECURSIVE base AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '-' ELSE '=' || lang END AS tree,
         sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', 'text'))}) AS leaf,
         CASE WHEN n_chars IS NULL THEN NULL ELSE
         sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', '(n_chars + 1)', 'text'))}) END AS other
  FROM documents),
crc AS MATERIALIZED (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
         AS v FROM range(256) t(i)),
crcs AS (SELECT list(v ORDER BY i) AS t FROM crc),
placed AS MATERIALIZED (
  SELECT doc_id, tree, leaf, CASE WHEN other IS NOT NULL AND xor(list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
           lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295::BIGINT) % 7 = 0
         THEN other ELSE leaf END AS claimed,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM base, crcs),
up AS (
  SELECT tree, 0 AS lev, place, leaf AS d, count(*) OVER (PARTITION BY tree) AS n FROM placed
  UNION ALL
  SELECT tree, lev + 1, place // 2, sha256(d || coalesce(nxt, '')), (n + 1) // 2
  FROM (SELECT *, lead(d) OVER (PARTITION BY tree ORDER BY place) AS nxt FROM up) q WHERE n > 1 AND place % 2 = 0),
nodes AS MATERIALIZED (SELECT * FROM up),
tops AS MATERIALIZED (
  SELECT tree, d AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM nodes WHERE n = 1),
up2 AS (
  SELECT 0 AS lev, place, subroot AS d, count(*) OVER () AS n FROM tops
  UNION ALL
  SELECT lev + 1, place // 2, sha256(d || coalesce(nxt, '')), (n + 1) // 2
  FROM (SELECT *, lead(d) OVER (ORDER BY place) AS nxt FROM up2) q WHERE n > 1 AND place % 2 = 0),
nodes2 AS MATERIALIZED (SELECT * FROM up2),
steps AS (
  SELECT p.tree, p.place, a.lev AS pos, (p.place >> a.lev) % 2 AS side, s.d AS sib
  FROM placed p JOIN (SELECT DISTINCT tree, lev FROM nodes WHERE n > 1) a ON a.tree = p.tree
  LEFT JOIN nodes s ON s.tree = p.tree AND s.lev = a.lev AND s.place = xor(p.place >> a.lev, 1::BIGINT)
  UNION ALL
  SELECT p.tree, p.place, 1000 + a.lev, (t.place >> a.lev) % 2, s.d
  FROM placed p JOIN tops t ON t.tree = p.tree CROSS JOIN (SELECT DISTINCT lev FROM nodes2 WHERE n > 1) a
  LEFT JOIN nodes2 s ON s.lev = a.lev AND s.place = xor(t.place >> a.lev, 1::BIGINT)),
paths AS (
  SELECT tree, place, string_agg(coalesce(sib, ''), '' ORDER BY pos) AS proof,
         list(CASE WHEN side = 1 THEN 'L' ELSE 'R' END || coalesce(sib, '') ORDER BY pos) AS path
  FROM steps GROUP BY tree, place),
joined AS (
  SELECT p.doc_id, p.leaf, t.subroot, (SELECT d FROM nodes2 WHERE n = 1) AS root,
         sha256(coalesce(proof, '')) AS proof_sha256,
         list_reduce(list_prepend(p.claimed, coalesce(path, [])), lambda d, s:
           CASE WHEN s[1] = 'L' THEN sha256(s[2:] || d) ELSE sha256(d || s[2:]) END) AS folded_root
  FROM placed p JOIN tops t ON t.tree = p.tree LEFT JOIN paths q ON q.tree = p.tree AND q.place = p.place)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM joined
"""
