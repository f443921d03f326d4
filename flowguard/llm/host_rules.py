"""Quality rules judged by host: documents' rule failures are counted by domain, rates are shrunk with an empirical
beta prior, and the hosts' verdicts go back to their documents. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.llm.common import WORD, cut, read_table

#: Rules by which a document counts against its host, and the highest shrunk rate of each that a host may have.
RULES: dict[str, tuple[str, float]] = {
    "base": ("base_failed", 0.5),
    "symbols": ("n_words > 0 AND 10 * n_symbols > 3 * n_words", 0.6),
    "dup_lines": ("n_lines > 0 AND 100 * n_dup_lines > 30 * n_lines", 0.6),
    "word_length": ("n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)", 0.6),
}
#: Prior strength where the hosts' rates don't tell one (a single host, or no spread), and its bounds.
NO_SPREAD, WEAKEST, STRONGEST = 10.0, 1.0, 1e6
#: With up to so many distinct repeated windows they are looked up one by one, beyond by sorting; same result.
FEW = 32


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def covered(positions: Column) -> Column:
    """Words within three-word windows that begin at the given rising positions."""
    step = lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last"))
    zero = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    return F.aggregate(positions, zero, step, lambda a: a["n"].cast("long"))


def places_by_lookup(windows: Column, repeated: Column) -> Column:
    at = F.transform(windows, lambda x, i: F.when(F.array_contains(repeated, x), i).otherwise(F.lit(-1)))
    return F.filter(at, lambda p: p >= 0)


def places_by_sorting(windows: Column) -> Column:
    pairs = F.array_sort(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

    def doubles(s: Column) -> Column:
        twin = lambda e, k: (F.get(s, k - 1)["x"].eqNullSafe(e["x"]) | F.get(s, k + 1)["x"].eqNullSafe(e["x"]))
        return F.array_sort(F.transform(F.filter(s, twin), lambda e: e["i"]))

    return let(pairs, doubles)


def repeated_words(words: Column) -> Column:
    """Words in three-word windows that a text has twice or more. Windows are compared by 64-bit hashes."""
    def of_windows(h: Column) -> Column:
        def of_sorted(s: Column) -> Column:
            again = F.array_distinct(F.filter(s, lambda x, i: (i > 0) & F.get(s, i - 1).eqNullSafe(x)))
            return let(again, lambda d: F.when(F.size(d) == 0, F.lit(0).cast("long"))
                       .when(F.size(d) <= FEW, covered(places_by_lookup(h, d)))
                       .otherwise(covered(places_by_sorting(h))))
        return let(F.sort_array(h), of_sorted)

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(
        F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(let(hashes, of_windows))


def text_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words and base_failed.

    Null texts count as empty: all zero, base_failed. Long texts are counted whole. Columns of these names in ``df``
    are replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD))
    of_words = let(F.regexp_extract_all(body, F.lit(WORD), F.lit(0)), lambda ws: F.struct(
        F.size(ws).cast("long").alias("n_words"), repeated_words(ws).alias("n_repeat_words")))
    of_lines = let(lines, lambda ls: F.struct(F.size(ls).cast("long").alias("n_lines"), (
        F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines")))
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed")
    return (df.withColumns({"_w": of_words, "_l": of_lines})
            .withColumns({"word_chars": (F.char_length(body) - F.regexp_count(body, F.lit(r"[\x20\x09-\x0D]"))).cast("long"),
                          "n_symbols": F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("long"),
                          "n_words": F.col("_w.n_words"), "n_repeat_words": F.col("_w.n_repeat_words"),
                          "n_lines": F.col("_l.n_lines"), "n_dup_lines": F.col("_l.n_dup_lines")})
            .withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))
            .select(*[c for c in df.columns if c not in names], *names))


def host_verdicts(stats: DataFrame, host: str = "source") -> DataFrame:
    """(host, n, host_rejected, <rule>_rate): shrunk failure rates of every host.

    The beta prior of a rule has the mean and spread of the hosts' own rates (method of moments); a host's rate is
    (a + failures) / (a + b + documents), so that hosts of few documents lean on the others. A host is rejected if any
    shrunk rate exceeds its rule's limit.
    """
    per = stats.where(F.col(host).isNotNull()).groupBy(host).agg(
        F.count("*").alias("n"), *[F.sum(F.expr(rule).cast("int")).alias(f"_{k}") for k, (rule, _) in RULES.items()])
    rates = [per[f"_{k}"] / per["n"] for k in RULES]
    row = per.agg(*[f(r).alias(f"{f.__name__}_{k}") for k, r in zip(RULES, rates, strict=True)
                    for f in (F.avg, F.var_samp)]).first()
    out, bad = [], F.lit(False)
    for k, (_, limit) in RULES.items():
        m, v = row[f"avg_{k}"] or 0.0, row[f"var_samp_{k}"] or 0.0
        strength = min(max(m * (1 - m) / v - 1, WEAKEST), STRONGEST) if v > 0 else NO_SPREAD
        shrunk = (F.col(f"_{k}") + F.lit(m * strength)) / (F.col("n") + F.lit(strength))
        out.append(shrunk.alias(f"{k}_rate"))
        bad = bad | (shrunk > limit)
    return per.select(host, "n", bad.alias("host_rejected"), *out)


def host_rules(df: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """``df`` with its statistics, the verdict of its host and ``kept``: neither base_failed nor of a rejected host.

    Every row stays, repeated rows too; a null host has no verdict and its documents are judged by base_failed alone.
    An empty table gives no rows. Hosts are aggregated before the shuffle; the verdicts, one row a host, come back by
    a join that AQE broadcasts when small and splits where one host has most rows.
    """
    stats = cut(text_statistics(df, text).drop(text))
    verdicts = host_verdicts(stats, host).withColumnRenamed(host, "_host").select("_host", "host_rejected")
    return (stats.drop("host_rejected").join(verdicts, F.col(host) == F.col("_host"), "left")
            .withColumn("host_rejected", F.coalesce("host_rejected", F.lit(False)))
            .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected")).drop("_host"))


def op9_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return host_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                   "base_failed", "kept")


OP9_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, unnest(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS w,
      generate_subscripts(regexp_extract_all(t, '[^\x20\x09-\x0D]+'), 1) AS i FROM d),
g AS (SELECT doc_id, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM w
      WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT doc_id, i, (w3 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, w, w2, w3) > 1)::INT AS twice FROM g),
c AS (SELECT doc_id, max(twice) OVER (PARTITION BY doc_id ORDER BY i ROWS 2 PRECEDING) AS hit FROM f),
r AS (SELECT doc_id, sum(hit) AS n_rep FROM c GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
m AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM l
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
s AS (SELECT d.doc_id, d.source, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))::BIGINT AS n_words,
      length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
      len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_lines, 0)::BIGINT AS n_lines,
      coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(n_rep, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN r USING (doc_id) LEFT JOIN m USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s),
u AS (SELECT source, base_failed::INT AS x, 'base' AS rule, 0.5 AS lim FROM b WHERE source IS NOT NULL
      UNION ALL SELECT source, (n_words > 0 AND 10 * n_symbols > 3 * n_words)::INT, 'symbols', 0.6 FROM b WHERE source IS NOT NULL
      UNION ALL SELECT source, (n_lines > 0 AND 100 * n_dup_lines > 30 * n_lines)::INT, 'dup', 0.6 FROM b WHERE source IS NOT NULL
      UNION ALL SELECT source, (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words))::INT, 'len', 0.6
      FROM b WHERE source IS NOT NULL),
h AS (SELECT source, rule, lim, count(*) AS n, sum(x) AS k, sum(x) / count(*) AS rate FROM u GROUP BY source, rule, lim),
p AS (SELECT rule, avg(rate) AS m, coalesce(var_samp(rate), 0) AS v FROM h GROUP BY rule),
q AS (SELECT rule, m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 1.0), 1e6) ELSE 10.0 END AS z FROM p),
x AS (SELECT source, bool_or((k + m * z) / (n + z) > lim) AS rejected FROM h JOIN q USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(rejected, FALSE) AS kept
FROM b LEFT JOIN x ON b.source = x.source
"""
