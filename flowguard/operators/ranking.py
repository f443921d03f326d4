"""Exact per-class ranks on a hash key without a full-table window.

A window ``row_number() over (partition by class order by hash)`` would put a
whole class in one task; normal traffic alone can be most of the table.  Here
one pass counts rows per class and hash prefix.  Class sizes and the prefix
that holds any k-th key follow from that small histogram, and only the rows of
those prefixes are ranked (counted again by a longer prefix while they are
many).  Rows are then labelled by comparing their key with the cut points of
their class: the big table is scanned twice, but never shuffled or copied.  All
counts and ranks come from one narrow table (class, key, id) written once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard.operators.joins import bounded_broadcast
from flowguard.session import cut

HASH = "_h"
HASH_BITS, STEP_BITS = 60, 16   # key width; bits that one histogram adds to the known prefix
EXACT_RANK_LIMIT = 2_000_000    # rows a prefix may hold before it is counted by a longer one
INLINE_CUTS = 500               # cut points inlined as CASE branches; with more, classes are joined to a table


def hash_key(seed: int, row_id: str = "row_id") -> Column:
    """Deterministic uniform key: the first 60 bits of md5('seed:row_id')."""
    text = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(row_id).cast("string")))
    return F.conv(F.substring(text, 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(bits: int) -> Column:
    return F.shiftright(F.col(HASH), max(0, HASH_BITS - bits))


def rank_cutoffs(keyed: DataFrame, hist: DataFrame, groups: list[str], targets: list[tuple], tie: str,
                 bits: int = STEP_BITS) -> dict:
    """Key of the k-th smallest ``(HASH, tie)`` per group.

    ``hist`` has ``(groups, _b, _n)``, the rows of ``keyed`` per group and
    prefix of ``bits``.  ``targets`` lists ``(tid, group values..., k)`` with
    1 <= k <= group size; the answer is ``{tid: (cut_key, cut_tie)}``.
    """
    spark = keyed.sparkSession
    types = [keyed.schema[c].dataType.simpleString() for c in groups]
    head = [f"`{c}` {t}" for c, t in zip(groups, types)]
    wanted = spark.createDataFrame(targets, ", ".join(["_tid string", *head, "k long"]))
    w = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = hist.withColumn("_cum", F.sum("_n").over(w))
    low = F.col("_cum") - F.col("_n")
    bnd = (cum.join(wanted, on=groups).where((low < F.col("k")) & (F.col("k") <= F.col("_cum")))
           .select("_tid", *groups, "_b", (F.col("k") - low).alias("_r"), "_n").collect())   # one row per target
    if not bnd:
        return {}
    rows = [(r["_tid"], *[r[c] for c in groups], r["_b"], r["_r"]) for r in bnd]
    held = spark.createDataFrame(rows, ", ".join(["_tid string", *head, "_b long", "_r long"]))
    inside = keyed.withColumn("_b", _prefix(bits)).join(
        bounded_broadcast(held.select(*groups, "_b").distinct()), on=[*groups, "_b"], how="left_semi")
    if max(r["_n"] for r in bnd) > EXACT_RANK_LIMIT and bits < HASH_BITS:
        name = f"_p{bits}"
        sub = inside.withColumnRenamed("_b", name)
        longer = min(HASH_BITS, bits + STEP_BITS)
        again = sub.groupBy(*groups, name, _prefix(longer).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
        return rank_cutoffs(sub, again, [*groups, name], rows, tie, longer)
    ranked = inside.withColumn("_rn", F.row_number().over(Window.partitionBy(*groups, "_b").orderBy(HASH, tie)))
    got = (ranked.join(held, on=[*groups, "_b"]).where(F.col("_rn") == F.col("_r"))
           .select("_tid", F.col(HASH).alias("cut_key"), F.col(tie).alias("cut_tie")).collect())
    return {r["_tid"]: (r["cut_key"], r["cut_tie"]) for r in got}


class ClassRanks:
    """Rows of a table ranked within their class by hash key, then row id.

    Rows whose class is null have no rank.  ``counts`` and ``assign`` share one
    histogram pass over the table.
    """

    def __init__(self, df: DataFrame, group: str, seed: int, row_id: str = "row_id"):
        self.df, self.group, self.row_id = df, group, row_id
        self.base = df.withColumn(HASH, hash_key(seed, row_id))
        self.keyed = cut(self.base.select(F.col(f"`{group}`").alias("_g"), HASH, F.col(row_id).alias("_id")).where(
            "_g IS NOT NULL"))
        self.hist = self.keyed.groupBy("_g", _prefix(STEP_BITS).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
        self._counts: dict | None = None

    def counts(self) -> dict:
        """``{class: rows}``."""
        if self._counts is None:
            self._counts = {r[0]: int(r[1]) for r in self.keyed.groupBy("_g").agg(F.count(F.lit(1))).collect()}
        return self._counts

    def ranked(self) -> DataFrame:
        """(_g, _id, _rank): the rank of every row in its class, from 1. The histogram says how many rows lie below a hash
        prefix, so that only the rows of a prefix are put in order together; a prefix of many rows goes by longer ones."""
        rows, hist, groups, bits = self.keyed, self.hist, ["_g"], STEP_BITS
        below = F.lit(0).cast("long")
        while True:
            w = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            name = f"_p{bits}"
            hist = cut(hist.withColumn("_below", F.sum("_n").over(w) - F.col("_n")))
            rows = rows.withColumn("_b", _prefix(bits)).join(hist, [*groups, "_b"]).withColumn(
                "_base", below + F.col("_below")).drop("_below", "_n").withColumnRenamed("_b", name)
            groups, below = [*groups, name], F.col("_base")
            if bits >= HASH_BITS or (hist.agg(F.max("_n")).first()[0] or 0) <= EXACT_RANK_LIMIT:
                break
            bits = min(HASH_BITS, bits + STEP_BITS)
            hist = rows.groupBy(*groups, _prefix(bits).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
        place = F.row_number().over(Window.partitionBy(*groups).orderBy(HASH, "_id"))
        return rows.select("_g", "_id", (F.col("_base") + place).alias("_rank"))

    def assign(self, boundaries: list[tuple], out: str, default, missing=None) -> DataFrame:
        """Label each row by the rank range its key falls in.

        ``boundaries`` lists ``(class, k, ord, value)``: a row of rank r gets the
        ``value`` of the boundary with the smallest ``(k, ord)`` such that
        r <= k; rows past the last boundary of their class get ``default``.
        Rows of a class without boundary, or of none, get ``missing``.
        """
        classes = sorted({b[0] for b in boundaries}, key=repr)
        bounds = sorted((b for b in boundaries if b[1] >= 1), key=lambda b: (repr(b[0]), b[1], b[2]))
        pairs = sorted({(b[0], int(b[1])) for b in bounds}, key=repr)
        tids = {p: str(i) for i, p in enumerate(pairs)}
        cuts = rank_cutoffs(self.keyed, self.hist, ["_g"], [(tids[p], *p) for p in pairs], "_id") if pairs else {}
        ranges = [(b[0], *cuts[tids[(b[0], int(b[1]))]], b[2], b[3]) for b in bounds]
        make = self._inlined if len(ranges) + len(classes) <= INLINE_CUTS else self._joined
        return make(classes, ranges, out, default, missing)

    def _inlined(self, classes, ranges, out, default, missing) -> DataFrame:
        """One literal map from class to its cut points. Class, key and id are bound once (``s``), however many cut points
        they are compared with, so that the expressions behind them are not repeated."""
        kind = self.df.schema[self.row_id].dataType
        gtype = self.df.schema[self.group].dataType
        if not classes:
            return self.base.withColumn(out, F.lit(missing)).drop(HASH)
        places = sorted({(r[3], r[4]) for r in ranges}, key=lambda v: v[0])
        low = F.struct(F.lit(-1).cast("long").alias("key"), F.lit(None).cast(kind).alias("tie"))  # below any key

        def cuts_of(c) -> Column:
            mine = {r[3]: F.struct(F.lit(r[1]).alias("key"), F.lit(r[2]).cast(kind).alias("tie")) for r in ranges if r[0] == c}
            return F.array(*[mine.get(place, low) for place, _ in places]) if places else F.array(low)

        of_class = F.create_map(*[x for c in classes for x in (F.lit(c).cast(gtype), cuts_of(c))])
        bound = F.struct(F.element_at(of_class, F.col(f"`{self.group}`")).alias("cuts"),
                         F.struct(F.col(HASH).alias("key"), F.col(self.row_id).alias("tie")).alias("mine"))

        def label(s: Column) -> Column:
            got = F.lit(default)
            for i, (_, value) in reversed(list(enumerate(places))):
                got = F.when(s["mine"] <= s["cuts"][i], F.lit(value)).otherwise(got)
            return F.when(s["cuts"].isNull(), F.lit(missing)).otherwise(got)

        return self.base.withColumn(out, F.get(F.transform(F.array(bound), label), F.lit(0))).drop(HASH)

    def _joined(self, classes, ranges, out, default, missing) -> DataFrame:
        """With many classes: their cut points as a table, one row a class, joined to the rows."""
        spark, kind = self.df.sparkSession, self.df.schema[self.row_id].dataType.simpleString()
        h, rid = F.col(HASH), F.col(self.row_id)
        values = [value for *_, value in ranges] + [default]
        vtype = "boolean" if isinstance(values[0], bool) else "long" if isinstance(values[0], int) else "string"
        gtype = self.df.schema[self.group].dataType.simpleString()
        by: dict = {c: [] for c in classes}
        for c, key, tie, _, value in ranges:
            by[c].append((key, tie, value))
        table = spark.createDataFrame([(c, cs) for c, cs in by.items()],
                                      f"_g {gtype}, _cuts array<struct<key:long,tie:{kind},value:{vtype}>>")
        hit = F.get(F.filter("_cuts", lambda s: (h < s["key"]) | ((h == s["key"]) & (rid <= s["tie"]))), 0)["value"]
        label = F.when(F.col("_g").isNull(), F.lit(missing)).otherwise(F.coalesce(hit, F.lit(default)))
        return (self.base.join(table, F.col(f"`{self.group}`") == F.col("_g"), "left").withColumn(out, label)
                .drop(HASH, "_g", "_cuts"))

