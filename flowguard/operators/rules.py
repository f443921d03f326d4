"""Decision trees as data: node tables, IF/THEN rules, and scoring expressions.

A trained MLlib tree is saved to the shared folder and its node table read
back as a DataFrame (a model: at most 2^(depth+1) rows, so the driver may walk
it).  From it we render the rules as text (``<=`` left, ``>`` right, two
decimals), select nodes to a depth for display, and compile the tree into one
column expression -- ``CASE`` on the feature columns giving the leaf id -- so
scoring stays inside whole-stage codegen.  The same tree renders to SQL.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowguard.session import checkpoint_dir

PROBABILITY = "probability"   # leaf value = P(attack) (binary stage)
CLASS = "class"               # leaf value = class index into ``classes``


@dataclass
class RuleTree:
    kind: str
    features: list[str]
    classes: list = field(default_factory=list)
    nodes: list[dict] = field(default_factory=list)   # id, feature, threshold, left, right, value, probs

    # -- persistence --------------------------------------------------------
    def to_json(self) -> str:
        return json.dumps(asdict(self), indent=1, sort_keys=True)

    @staticmethod
    def from_json(text: str) -> RuleTree:
        d = json.loads(text)
        return RuleTree(d["kind"], d["features"], d.get("classes", []), d["nodes"])

    def save(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as f:
            f.write(self.to_json())

    @staticmethod
    def load(path: str) -> RuleTree:
        with open(path, encoding="utf-8") as f:
            return RuleTree.from_json(f.read())

    # -- structure ----------------------------------------------------------
    @property
    def by_id(self) -> dict[int, dict]:
        return {n["id"]: n for n in self.nodes}

    @property
    def root(self) -> int:
        children = {c for n in self.nodes for c in (n["left"], n["right"]) if c >= 0}
        return next(n["id"] for n in self.nodes if n["id"] not in children)

    def is_leaf(self, node: dict) -> bool:
        return node["left"] < 0

    def leaves(self) -> list[dict]:
        return [n for n in self.nodes if self.is_leaf(n)]

    def depth(self) -> int:
        nodes = self.by_id

        def d(i):
            n = nodes[i]
            return 0 if self.is_leaf(n) else 1 + max(d(n["left"]), d(n["right"]))
        return d(self.root)

    def leaf_label(self, node: dict):
        """Displayed class of a leaf (probability trees: 1 iff p > 0.5)."""
        if self.kind == PROBABILITY:
            return 1 if node["value"] > 0.5 else 0
        return self.classes[int(node["value"])]

    def leaf_confidence(self, node: dict) -> float:
        if self.kind == PROBABILITY:
            return float(node["value"])
        probs = node.get("probs") or []
        return float(max(probs)) if probs else 1.0


def tree_from_model(spark: SparkSession, model, features: list[str], kind: str,
                    classes: list | None = None) -> RuleTree:
    """Node table of a fitted DecisionTree{Classification,Regression}Model."""
    path = os.path.join(checkpoint_dir(spark), "trees", uuid.uuid4().hex)
    model.write().overwrite().save(path)
    rows = spark.read.parquet(os.path.join(path, "data")).collect()   # model-sized
    nodes = []
    for r in rows:
        leaf = r["leftChild"] < 0
        stats = list(r["impurityStats"] or [])
        if kind == CLASS:
            tot = sum(stats)
            probs = [s / tot for s in stats] if tot > 0 else stats
        else:
            probs = []
        nodes.append({
            "id": int(r["id"]), "left": int(r["leftChild"]), "right": int(r["rightChild"]),
            "feature": None if leaf else features[r["split"]["featureIndex"]],
            "threshold": None if leaf else float(r["split"]["leftCategoriesOrThreshold"][0]),
            "value": float(r["prediction"]), "probs": probs, "count": int(r["rawCount"]),
        })
    nodes.sort(key=lambda n: n["id"])
    return RuleTree(kind, list(features), list(classes or []), nodes)


# -- compiled scoring ----------------------------------------------------------

def leaf_expr(tree: RuleTree) -> Column:
    """Leaf id of each row: nested ``when(feature <= threshold)`` expressions."""
    nodes = tree.by_id

    def build(i: int) -> Column:
        n = nodes[i]
        if tree.is_leaf(n):
            return F.lit(n["id"])
        return F.when(F.col(f"`{n['feature']}`") <= F.lit(n["threshold"]), build(n["left"])).otherwise(
            build(n["right"]))
    return build(tree.root)


def _leaf_map(tree: RuleTree, fn) -> Column:
    items = []
    for n in tree.leaves():
        items += [F.lit(n["id"]), F.lit(fn(n))]
    return F.create_map(*items)


def score_columns(tree: RuleTree, leaf: Column | None = None) -> dict[str, Column]:
    """Scoring columns from the leaf id: ``p`` (probability trees) or
    ``label`` and ``confidence`` (class trees)."""
    leaf = leaf_expr(tree) if leaf is None else leaf
    if tree.kind == PROBABILITY:
        return {"p": F.element_at(_leaf_map(tree, lambda n: float(n["value"])), leaf)}
    return {"label": F.element_at(_leaf_map(tree, lambda n: str(tree.leaf_label(n))), leaf),
            "confidence": F.element_at(_leaf_map(tree, tree.leaf_confidence), leaf)}


def to_sql_case(tree: RuleTree) -> str:
    """The leaf-id expression as ANSI SQL (double-quoted identifiers)."""
    nodes = tree.by_id

    def build(i: int) -> str:
        n = nodes[i]
        if tree.is_leaf(n):
            return str(n["id"])
        return (f'CASE WHEN "{n["feature"]}" <= CAST(\'{n["threshold"]!r}\' AS DOUBLE) '
                f'THEN {build(n["left"])} ELSE {build(n["right"])} END')
    return build(tree.root)


def leaf_values_sql(tree: RuleTree, name: str) -> str:
    """``name(leaf, p)`` or ``name(leaf, label, confidence)`` as a VALUES CTE."""
    if tree.kind == PROBABILITY:
        rows = ", ".join(f"({n['id']}, CAST('{float(n['value'])!r}' AS DOUBLE))" for n in tree.leaves())
        return f"{name}(leaf, p) AS (VALUES {rows})"
    rows = ", ".join(
        f"({n['id']}, '{tree.leaf_label(n)}', CAST('{tree.leaf_confidence(n)!r}' AS DOUBLE))"
        for n in tree.leaves())
    return f"{name}(leaf, label, confidence) AS (VALUES {rows})"


# -- rendering -----------------------------------------------------------------

def to_text(tree: RuleTree, decimals: int = 2) -> str:
    """IF/THEN text of the whole tree: a line ``f <= t`` before the lower
    branch, ``f >  t`` before the upper one, ``class: c`` for a leaf, each with
    one bar per level."""
    nodes = tree.by_id
    items: list[tuple[int, str]] = []
    waiting: list = [(0, tree.root)]
    while waiting:
        depth, item = waiting.pop()
        if isinstance(item, str):
            items.append((depth, item))
            continue
        node = nodes[item]
        if tree.is_leaf(node):
            items.append((depth, f"class: {tree.leaf_label(node)}"))
            continue
        at = f"{node['threshold']:.{decimals}f}"
        waiting += [(depth + 1, node["right"]), (depth, f"{node['feature']} >  {at}"),
                    (depth + 1, node["left"]), (depth, f"{node['feature']} <= {at}")]
    return "".join("|   " * depth + f"|--- {text}\n" for depth, text in items)


def node_rows(tree: RuleTree) -> list[tuple]:
    """``(id, depth, parent, side, feature, threshold, is_leaf, label, confidence, rule)``."""
    nodes = tree.by_id
    out = []

    def walk(i, depth, parent, side, conds):
        n = nodes[i]
        leaf = tree.is_leaf(n)
        out.append((n["id"], depth, parent, side, n["feature"], n["threshold"], leaf,
                    str(tree.leaf_label(n)), tree.leaf_confidence(n), " AND ".join(conds) or "TRUE"))
        if not leaf:
            thr = f"{n['threshold']:.2f}"
            walk(n["left"], depth + 1, n["id"], "left", conds + [f"{n['feature']} <= {thr}"])
            walk(n["right"], depth + 1, n["id"], "right", conds + [f"{n['feature']} > {thr}"])
    walk(tree.root, 0, None, None, [])
    return out


NODE_SCHEMA = ("id int, depth int, parent int, side string, feature string, threshold double, "
               "is_leaf boolean, label string, confidence double, rule string")


def node_table(spark: SparkSession, tree: RuleTree) -> DataFrame:
    return spark.createDataFrame(node_rows(tree), NODE_SCHEMA)


def rules_table(spark: SparkSession, tree: RuleTree) -> DataFrame:
    """One row per leaf: its conjunction of conditions and its answer."""
    return node_table(spark, tree).where("is_leaf").select(
        F.col("id").alias("leaf"), "rule", "label", "confidence", "depth")


def structure_to_depth(spark: SparkSession, tree: RuleTree, depth: int) -> DataFrame:
    """Nodes down to ``depth`` (the drawn part of the tree)."""
    return node_table(spark, tree).where(F.col("depth") <= depth)


def write_rules_text(spark: SparkSession, tree: RuleTree, path: str) -> None:
    """Rules text as a one-partition text table (it is model-sized)."""
    lines = to_text(tree).rstrip("\n").split("\n")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode(
        "overwrite").text(path)


def read_rules_text(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): the lines of rule files, numbered as they stand."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return whole.select("file", F.posexplode(F.split("value", "\r?\n")).alias("line", "value")).where("value <> ''")


# -- rule text as input ------------------------------------------------------------

#: A line of rule text: bars for the levels above, then a condition of a branch or the class of a leaf.
RULE_LINE = r"^((?:\|   )*)\|--- (?:class: (.*)|(.*\S) (<=|> ) (\S+))$"


def parse_rules(lines: DataFrame) -> DataFrame:
    """Nodes (file, id, depth, parent, side, feature, threshold, is_leaf, label) of rule texts (file, line, value).

    A line's depth is its number of bars. A node starts at its ``<=`` line or its class; its parent is the node whose
    branch line stands last above it, one level up, and tells the side. Nodes are numbered from 0 in the order of the
    lines. Each file is a window of its own. A line of another form gives a node without feature and class, which
    ``tree_from_nodes`` refuses.
    """
    part = lambda i: F.regexp_extract("value", RULE_LINE, i)
    rows = lines.select("file", "line", (F.length(part(1)) / 4).cast("int").alias("depth"), part(2).alias("label"),
                        part(3).alias("feature"), F.trim(part(4)).alias("sign"),
                        F.expr("try_cast(" + f"regexp_extract(value, r'{RULE_LINE}', 5)" + " AS DOUBLE)").alias("threshold"))
    deepest = rows.agg(F.max("depth")).first()[0] or 0
    above = Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = F.col("sign") != ">"
    rows = rows.withColumn("id", (F.count(F.when(starts, 1)).over(upto) - 1).cast("int"))

    def last_above(of, kind):
        """By level: the last value of ``of`` on an earlier line of that level and kind."""
        found = [F.last(F.when((F.col("depth") == k) & kind, of), ignorenulls=True).over(above) for k in range(deepest + 1)]
        return F.get(F.array(*found), F.col("depth") - 1)

    parent = last_above(F.col("id"), F.col("sign") == "<=")
    side = last_above(F.when(F.col("sign") == "<=", "left").otherwise("right"), F.col("sign") != "")
    leaf = (F.col("sign") == "") & (F.col("label") != "")
    return rows.withColumns({"parent": parent, "side": side}).where(starts).select(
        "file", "id", "depth", "parent", "side", F.when(F.col("sign") == "<=", F.col("feature")).alias("feature"),
        F.when(F.col("sign") == "<=", F.col("threshold")).alias("threshold"), leaf.alias("is_leaf"),
        F.when(leaf, F.col("label")).alias("label"))


def tree_from_nodes(nodes: DataFrame, kind: str = CLASS) -> RuleTree:
    """The tree of one file's nodes (a model: the driver holds it). Leaves have no probabilities: of a class tree their
    confidence is 1, of a probability tree (classes 0 and 1) they are 0 or 1."""
    rows = sorted(nodes.collect(), key=lambda r: r["id"])
    child = {(r["parent"], r["side"]): r["id"] for r in rows if r["parent"] is not None}
    classes = sorted({r["label"] for r in rows if r["is_leaf"]})
    out = []
    for r in rows:
        left, right = child.get((r["id"], "left"), -1), child.get((r["id"], "right"), -1)
        whole = r["is_leaf"] and left < 0 and right < 0 or (
            not r["is_leaf"] and r["feature"] and r["threshold"] is not None and left >= 0 and right >= 0)
        if not whole or (r["parent"] is None) != (r["id"] == 0):
            raise ValueError(f"node {r['id']} of the rule text is neither a leaf nor a condition with two branches")
        value = (float(r["label"]) if kind == PROBABILITY else float(classes.index(r["label"]))) if r["is_leaf"] else 0.0
        out.append({"id": r["id"], "left": left, "right": right, "feature": r["feature"], "threshold": r["threshold"],
                    "value": value, "probs": [], "count": 0})
    if not out:
        raise ValueError("the rule text has no line")
    features = list(dict.fromkeys(n["feature"] for n in out if n["feature"]))
    return RuleTree(kind, features, [] if kind == PROBABILITY else classes, out)


def tree_from_text(spark: SparkSession, path: str, kind: str = CLASS) -> RuleTree:
    """The tree of a rule file. Its thresholds are those of the text, which has two decimals."""
    return tree_from_nodes(parse_rules(read_rules_text(spark, path)), kind)
