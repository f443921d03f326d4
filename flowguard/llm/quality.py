"""Quality classifier: a sparse rule ensemble.

Paths of small trees become conjunctive rules over text statistics, lasso logistic regression weighs them, and the
rules that keep a weight are compiled into one column expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.llm.common import BLANKS, WORD, crc_of_id, cut, read_table
from flowguard.llm.host_rules import let

#: Labelled rows that a fit uses at most (about; drawn by a hash of the id).
FIT_ROWS = 20_000
TREES, DEPTH, LASSO, ROUNDS, SEED = 20, 3, 0.001, 60, 11
#: Scores from this value on are predicted as 1.
CUT = 0.7
STATISTICS = ("words", "word_chars", "short", "upper", "marks", "stops", "bangs", "pipes", "digits", "accents",
              "distinct", "lines", "same_lines", "first_upper")


def statistics(df: DataFrame, text: str = "text", names: tuple[str, ...] = STATISTICS) -> DataFrame:
    """``df`` with one struct column ``_s`` of STATISTICS (or those of ``names``), all doubles and defined for every text
    (null: empty).

    Mostly shares: of characters in words (upper case, marks, bangs, pipes, digits, other than ASCII), of words (one
    to three characters long, ending a sentence, distinct, capitalised) and of lines (per word, equal to another).
    Native functions only, over the whole text, whatever its length.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    count = lambda pattern: F.regexp_count(body, F.lit(pattern)).cast("double")
    # a single character is found without a regular expression
    single = lambda c: (F.octet_length(body) - F.octet_length(F.replace(body, F.lit(c), F.lit("")))).cast("double")
    size = lambda a: F.size(a).cast("double")

    def of_words(ws: Column) -> dict[str, Column]:
        """From the pieces between blanks: the words, and an empty one at either end of a text that has a blank there."""
        return {"w": size(F.array_remove(ws, "")), "c": F.char_length(F.array_join(ws, "")).cast("double"),
                "short": size(F.filter(ws, lambda x: F.char_length(x).between(1, 3))),
                "first": size(F.filter(ws, lambda x: (x >= "A") & (x < "["))), "different": size(F.array_distinct(ws))}

    def of_lines(ls: Column) -> dict[str, Column]:
        return {"n": size(ls), "d": size(F.array_distinct(ls))}

    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD))
    counts = {"upper": count("[A-Z]"), "marks": count(r"[#*$%&<>@^~=_{}\\]"),
              "stops": count(r"[.?](?![^\x20\x09-\x0D])"), "bangs": single("!"), "pipes": single("|"),
              "digits": count("[0-9]"), "accents": count(r"[^\x00-\x7F]")}
    #: statistic -> (what is counted, per words, characters or lines)
    shares = {"words": ("w", None), "word_chars": ("c", "w"), "short": ("short", "w"), "upper": ("upper", "c"),
              "marks": ("marks", "c"), "stops": ("stops", "w"), "bangs": ("bangs", "c"), "pipes": ("pipes", "w"),
              "digits": ("digits", "c"), "accents": ("accents", "c"), "distinct": ("different", "w"), "lines": ("n", "w"),
              "same_lines": ("same", "n"), "first_upper": ("first", "w")}
    used = {x for name in names for x in shares[name]} | ({"d"} if "same_lines" in names else set())

    def kept_of(made: dict[str, Column]) -> Column:
        return F.struct(*[v.alias(k) for k, v in made.items() if k in used], F.lit(0).alias("_"))

    raw = F.struct(let(F.split(body, BLANKS), lambda ws: kept_of(of_words(ws))).alias("t"),
                   let(lines, lambda ls: kept_of(of_lines(ls))).alias("l"), kept_of(counts).alias("r"))

    def made(r: Column) -> Column:
        def at(k: str) -> Column:
            if k == "same":
                return at("n") - at("d")
            return r["r"][k] if k in counts else r["l"][k] if k in ("n", "d") else r["t"][k]
        return F.struct(*[(at(k) if per is None else at(k) / F.greatest(at(per), F.lit(1.0))).alias(name)
                          for name, (k, per) in shares.items() if name in names])

    # bound once, so that no share counts again what another one has counted
    return df.withColumn("_s", let(raw, made))


@dataclass(frozen=True)
class Rule:
    """Conditions (statistic, above, threshold), all of which hold; above: > threshold, else <=."""
    conditions: tuple[tuple[str, bool, float], ...]

    def column(self, stats: Column | None = None) -> Column:
        """Whether the conditions hold for ``stats`` (column ``_s``, if not given)."""
        stats, out = F.col("_s") if stats is None else stats, F.lit(True)
        for name, above, at in self.conditions:
            x = stats[name]
            out = out & ((x > at) if above else (x <= at))
        return out

    def __str__(self) -> str:
        return " AND ".join(f"{n} {'>' if above else '<='} {at:.6g}" for n, above, at in self.conditions)


@dataclass(frozen=True)
class Ensemble:
    """Weighted rules; the score is the logistic function of intercept and the weights of the rules that hold."""
    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def used(self) -> tuple[str, ...]:
        """The statistics that its rules look at (one at least)."""
        return tuple(sorted({name for rule, _ in self.weights for name, *_ in rule.conditions})) or STATISTICS[:1]

    def column(self) -> Column:
        """The score; ``_s`` is named once in it, so that a filter that moves below ``_s`` computes it once."""
        def weighed(stats: Column) -> Column:
            z = F.lit(self.intercept)
            for rule, w in self.weights:
                z = z + F.when(rule.column(stats), F.lit(w)).otherwise(F.lit(0.0))
            return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        return let(F.col("_s"), weighed)


def paths(node, held: tuple = ()) -> list[tuple]:
    """Conditions of every node below the root, merged by statistic and side."""
    out = [held] if held else []
    if node.subtreeDepth() > 0:
        name, at = STATISTICS[node.split().featureIndex()], float(node.split().threshold())
        for above, child in ((False, node.leftChild()), (True, node.rightChild())):
            closer = [c for c in held if c[:2] == (name, above)]
            tight = (max if above else min)([at, *(c[2] for c in closer)])
            out += paths(child, tuple(sorted([c for c in held if c not in closer] + [(name, above, tight)])))
    return out


def fit(labelled: DataFrame, label: str = "quality") -> Ensemble:
    """An ensemble from rows of ``_s`` and ``label`` (0 or 1).

    Without rows of both labels there is nothing to learn: the ensemble has no rules and scores all texts alike, near 1
    if every label is 1 or there is none, near 0 if every label is 0. If no statistic parts the labels, all texts score
    the share of label 1.
    """
    rows = cut(labelled.where(F.col(label).isin(0, 1)).select("_s.*", F.col(label).cast("double").alias("_y")))
    seen = {r["_y"] for r in rows.select("_y").distinct().collect()}
    if len(seen) < 2:
        return Ensemble(-6.0 if seen == {0.0} else 6.0, ())
    features = VectorAssembler(inputCols=list(STATISTICS), outputCol="_x").transform(rows)
    forest = RandomForestClassifier(labelCol="_y", featuresCol="_x", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
                                    featureSubsetStrategy="onethird", minInstancesPerNode=5).fit(features)
    rules = sorted({Rule(p) for tree in forest.trees for p in paths(tree._call_java("rootNode"))}, key=str)
    if not rules:
        ones = rows.agg(F.avg("_y")).first()[0]
        return Ensemble(math.log(ones / (1 - ones)), ())
    held = rows.select("_y", F.struct(*[F.col(k) for k in STATISTICS]).alias("_s")).select(
        "_y", *[r.column().cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    matrix = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="_x").transform(held)
    lasso = LogisticRegression(labelCol="_y", featuresCol="_x", elasticNetParam=1.0, regParam=LASSO, maxIter=ROUNDS,
                               standardization=False).fit(cut(matrix.select("_y", "_x")))
    return Ensemble(float(lasso.intercept), tuple(
        (r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if abs(w) > 1e-6))


def labelled_sample(docs: DataFrame, labels: DataFrame, keep: Column, doc_id: str = "doc_id", label: str = "quality",
                    most: int = FIT_ROWS) -> DataFrame:
    """Documents with a label that fulfil ``keep`` (a condition on the id): all, or about ``most`` drawn by a hash of
    the id, which is applied to both tables before they are joined."""
    known = labels.select(doc_id, F.col(label).cast("int").alias(label)).where(
        F.col(label).isNotNull() & F.col(doc_id).isNotNull() & keep)
    n = known.count()
    drawn = F.pmod(F.xxhash64(F.lit(SEED), F.col(doc_id).cast("string")), F.lit(1_000_000)) < int(
        1e6 * min(1.0, most / max(n, 1)))
    one = known.where(drawn).groupBy(doc_id).agg(F.min(label).alias(label))
    return docs.where(drawn).join(one, doc_id)


def fit_on(docs: DataFrame, labels: DataFrame, keep: Column, doc_id: str = "doc_id", text: str = "text",
           label: str = "quality") -> Ensemble:
    """Fit on labelled documents. Only the text makes the statistics; repeated labels of an id count as their least."""
    plain = docs.select(doc_id, F.col(text).alias("_text"))
    return fit(statistics(labelled_sample(plain, labels, keep, doc_id, label), "_text"), label)


def score(df: DataFrame, ensemble: Ensemble, text: str = "text") -> DataFrame:
    """``df`` with ``score`` (0 to 1) and ``predicted`` (1 if score >= CUT). Every row stays; null and empty texts are
    scored by their (zero) statistics; columns of these names are replaced. One scan, no shuffle, no Python."""
    return (statistics(df, text, ensemble.used()).withColumn("score", ensemble.column())
            .withColumn("predicted", (F.col("score") >= CUT).cast("int")).drop("_s"))


def kept(df: DataFrame, ensemble: Ensemble, text: str = "text") -> DataFrame:
    """The rows of ``df``, its own columns only, that ``score`` would predict as 1."""
    return statistics(df, text, ensemble.used()).where(ensemble.column() >= CUT).select(*df.columns)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    out = crc_of_id("doc_id") % 4 == 2
    ensemble = fit_on(docs, labels, ~out)
    return score(docs.select("doc_id", "text", out.alias("held_out")), ensemble).select(
        "doc_id", "held_out", "score", "predicted")
