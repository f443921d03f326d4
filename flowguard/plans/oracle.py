"""DuckDB SQL for the registered queries (the correctness oracle).

Written by hand against the same parquet views, without code of the Spark
implementation: of the exported rule trees it reads the stored nodes and
walks them in SQL.  Names with blanks or '/' are double-quoted.
"""

from __future__ import annotations

# Raw flow table over ``events`` (same shaping as sources/adapters.py).
FLOWS_RAW = """
ev AS (
  SELECT *, CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) AS k FROM events
),
flows_raw AS (
  SELECT event_id AS row_id,
         value * CAST(1000 AS DOUBLE) AS " Flow Duration",
         k AS "Total Fwd Packets",
         CAST(event_id % 1460 AS DOUBLE) AS "Fwd Packet Length Max",
         CASE WHEN event_id % 97 = 0 THEN CAST('inf' AS DOUBLE)
              WHEN event_id % 101 = 0 THEN CAST('nan' AS DOUBLE)
              WHEN event_id % 103 = 0 THEN NULL
              ELSE value / (k + CAST(1 AS DOUBLE)) END AS "Flow Bytes/s",
         CASE WHEN event_id % 211 = 0 THEN CAST('-inf' AS DOUBLE)
              ELSE (k + CAST(1 AS DOUBLE)) / (value + CAST(1 AS DOUBLE)) END AS "Flow Packets/s ",
         CAST(event_id % 2 AS DOUBLE) AS "SYN Flag Count",
         CAST(0 AS DOUBLE) AS "Bwd PSH Flags",
         CAST(user_id % 3 AS DOUBLE) AS "Down/Up Ratio",
         value / (value + CAST(50 AS DOUBLE)) AS "Unit Score",
         '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.1' AS "Source IP",
         CASE WHEN event_id % 4999 = 0 THEN 'Infiltration'
              WHEN event_id % 53 = 0 THEN 'BENIGN'
              WHEN event_id % 599 = 0 THEN 'DDoS'
              WHEN value <= 100 THEN CASE WHEN event_id % 2 = 0 THEN 'BENIGN' ELSE ' Benign ' END
              WHEN k < 25 THEN 'DDoS'
              WHEN k < 45 THEN 'DoS Hulk'
              WHEN k < 55 THEN 'DoS slowloris'
              WHEN k < 75 THEN 'PortScan'
              WHEN k < 85 THEN 'FTP-Patator'
              WHEN k < 92 THEN 'Bot'
              ELSE 'Web Attack ' || chr(65533) || ' XSS' END AS "Label",
         event_type AS source
  FROM ev
)"""

# Label -> family, written as a VALUES table.
FAMILY_VALUES = """
fam(key, family) AS (VALUES
  ('BENIGN','Benign'), ('DDOS','DDoS'), ('DOS HULK','DoS'), ('DOS GOLDENEYE','DoS'),
  ('DOS SLOWLORIS','DoS'), ('DOS SLOWHTTPTEST','DoS'), ('HEARTBLEED','DoS'),
  ('PORTSCAN','PortScan'), ('BOT','Botnet'), ('FTP-PATATOR','Bruteforce'),
  ('SSH-PATATOR','Bruteforce'), ('INFILTRATION','Infiltration'),
  ('WEB ATTACK ' || chr(65533) || ' BRUTE FORCE','WebAttacks'),
  ('WEB ATTACK ' || chr(65533) || ' XSS','WebAttacks'),
  ('WEB ATTACK ' || chr(65533) || ' SQL INJECTION','WebAttacks'))"""

_FIN = "CASE WHEN isnan({c}) OR isinf({c}) THEN NULL ELSE {c} END"

# Cleaned flows with targets (names stripped, non-finite -> null, any-null dropped).
FLOWS_CLEAN = FLOWS_RAW + "," + FAMILY_VALUES + """,
flows_fin AS (
  SELECT row_id,
         """ + _FIN.format(c='" Flow Duration"') + """ AS "Flow Duration",
         """ + _FIN.format(c='"Total Fwd Packets"') + """ AS "Total Fwd Packets",
         """ + _FIN.format(c='"Fwd Packet Length Max"') + """ AS "Fwd Packet Length Max",
         """ + _FIN.format(c='"Flow Bytes/s"') + """ AS "Flow Bytes/s",
         """ + _FIN.format(c='"Flow Packets/s "') + """ AS "Flow Packets/s",
         """ + _FIN.format(c='"SYN Flag Count"') + """ AS "SYN Flag Count",
         """ + _FIN.format(c='"Bwd PSH Flags"') + """ AS "Bwd PSH Flags",
         """ + _FIN.format(c='"Down/Up Ratio"') + """ AS "Down/Up Ratio",
         """ + _FIN.format(c='"Unit Score"') + """ AS "Unit Score",
         "Source IP", "Label"
  FROM flows_raw
),
flows_nn AS (SELECT * FROM flows_fin WHERE COLUMNS(*) IS NOT NULL),
flows AS (
  SELECT f.*,
         CASE WHEN upper(trim(f."Label")) = 'BENIGN' THEN 0 ELSE 1 END AS target_bin,
         COALESCE(fam.family,
                  CASE WHEN starts_with(upper(trim(f."Label")), 'WEB ATTACK') THEN 'WebAttacks' END) AS target_tipo
  FROM flows_nn f LEFT JOIN fam ON fam.key = upper(trim(f."Label"))
)"""


def with_flows(body: str) -> str:
    return "WITH RECURSIVE " + FLOWS_CLEAN + body


ORACLE: dict[str, str] = {}

ORACLE["class_distribution"] = with_flows("""
SELECT target_tipo, count(*) AS n,
       CAST(count(*) AS DOUBLE) * 100.0 / CAST(sum(count(*)) OVER () AS DOUBLE) AS pct
FROM flows GROUP BY target_tipo
""")

ORACLE["unmapped_labels"] = "WITH " + FLOWS_RAW + "," + FAMILY_VALUES + """
SELECT "Label" AS label, upper(trim("Label")) AS label_key, count(*) AS n
FROM flows_raw LEFT JOIN fam ON fam.key = upper(trim("Label"))
WHERE fam.family IS NULL AND NOT starts_with(upper(trim("Label")), 'WEB ATTACK')
GROUP BY 1, 2
"""


# --- sampling -------------------------------------------------------------------

def alloc_sql(name: str, counts: str, test_sql: str) -> str:
    """CTE ``name(c, n, n_train)``: largest-remainder train sizes of a stratified
    split of the count table ``counts(c, n)``; ``test_sql`` is a SQL expression
    of the total ``tot`` giving the test size."""
    return f"""
{name}_t AS (
  SELECT c, n, CAST(sum(n) OVER () AS BIGINT) AS tot FROM {counts}
),
{name}_u AS (
  SELECT c, n, tot - CAST({test_sql} AS BIGINT) AS draw FROM {name}_t
),
{name}_v AS (
  SELECT c, n, draw, CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE) * CAST(draw AS DOUBLE) AS cont
  FROM {name}_u
),
{name} AS (
  SELECT c, n, CAST(floor(cont) AS BIGINT)
         + CASE WHEN row_number() OVER (ORDER BY cont - floor(cont) DESC, c)
                     <= draw - sum(CAST(floor(cont) AS BIGINT)) OVER () THEN 1 ELSE 0 END AS n_train
  FROM {name}_v
)"""


HASH_ORDER = "md5(concat_ws(':', 42, row_id)), row_id"


def holdout_sql() -> str:
    """CTEs ``hold(row_id)``: the canonical 15 % holdout of ``flows``."""
    return """,
hc0 AS (SELECT target_tipo AS c, count(*) AS n FROM flows GROUP BY 1),
hvalid AS (SELECT f.* FROM flows f JOIN hc0 ON hc0.c = f.target_tipo WHERE hc0.n >= 2),
hc AS (SELECT target_tipo AS c, count(*) AS n FROM hvalid GROUP BY 1),""" + alloc_sql(
        "ha", "hc", "ceil(0.15::DOUBLE * tot)") + """,
hrank AS (SELECT row_id, target_tipo,
                 row_number() OVER (PARTITION BY target_tipo ORDER BY """ + HASH_ORDER + """) AS rnk
          FROM hvalid),
hold AS (SELECT r.row_id FROM hrank r JOIN ha ON ha.c = r.target_tipo WHERE r.rnk > ha.n_train)"""


def three_way_sql(src: str, label: str, prefix: str) -> str:
    """CTE ``{prefix}parts(row_id, part, ...)``: 70/15/15 split of ``src`` by ``label``."""
    p = prefix
    return f""",
{p}c AS (SELECT {label} AS c, count(*) AS n FROM {src} GROUP BY 1),""" + alloc_sql(
        f"{p}a1", f"{p}c", "ceil(0.15::DOUBLE * tot)") + f""",
{p}c2 AS (SELECT c, n_train AS n FROM {p}a1),""" + alloc_sql(
        f"{p}a2", f"{p}c2", "ceil((0.15::DOUBLE / (1.0::DOUBLE - 0.15::DOUBLE)) * tot)") + f""",
{p}rank AS (SELECT s.*, row_number() OVER (PARTITION BY {label} ORDER BY {HASH_ORDER}) AS rnk FROM {src} s),
{p}parts AS (
  SELECT r.*, CASE WHEN r.rnk <= {p}a2.n_train THEN 'train'
                   WHEN r.rnk <= {p}a1.n_train THEN 'val' ELSE 'test' END AS part
  FROM {p}rank r JOIN {p}a1 ON {p}a1.c = r.{label} JOIN {p}a2 ON {p}a2.c = r.{label}
)"""


ORACLE["stratified_split_rows"] = with_flows(three_way_sql("flows", "target_tipo", "s") + """
SELECT row_id, target_tipo, part FROM sparts
""")

ORACLE["stratified_split_counts"] = with_flows(three_way_sql("flows", "target_tipo", "s") + """
SELECT part, target_tipo, count(*) AS n FROM sparts GROUP BY 1, 2
""")

ORACLE["sample_audit"] = with_flows(""",
sc AS (SELECT target_tipo AS c, count(*) AS n FROM flows GROUP BY 1),""" + alloc_sql(
    "sa", "sc", "ceil(0.10::DOUBLE * tot)") + """,
srank AS (SELECT target_tipo, row_number() OVER (PARTITION BY target_tipo ORDER BY """ + HASH_ORDER + """) AS rnk
          FROM flows),
samp AS (SELECT r.target_tipo FROM srank r JOIN sa ON sa.c = r.target_tipo WHERE r.rnk > sa.n_train),
fp AS (SELECT target_tipo, CAST(count(*) AS DOUBLE) * 100.0 / CAST(sum(count(*)) OVER () AS DOUBLE) AS full_pct
       FROM flows GROUP BY 1),
sp AS (SELECT target_tipo, CAST(count(*) AS DOUBLE) * 100.0 / CAST(sum(count(*)) OVER () AS DOUBLE) AS sample_pct
       FROM samp GROUP BY 1),
au AS (SELECT fp.target_tipo, fp.full_pct, COALESCE(sp.sample_pct, 0.0) AS sample_pct,
              COALESCE(sp.sample_pct, 0.0) - fp.full_pct AS deviation
       FROM fp LEFT JOIN sp USING (target_tipo))
SELECT target_tipo, full_pct, sample_pct, deviation,
       CASE WHEN abs(deviation) <= 2.0 THEN 'OK' ELSE 'ERRO (>2%)' END AS status,
       bool_and(abs(deviation) <= 2.0) OVER () AS validated
FROM au
""")

ORACLE["canonical_holdout_rows"] = with_flows(holdout_sql() + """
SELECT row_id FROM hold
""")

ORACLE["train_without_holdout"] = with_flows(holdout_sql() + """
SELECT row_id, target_tipo FROM flows WHERE row_id NOT IN (SELECT row_id FROM hold)
""")

ORACLE["holdout_class_counts"] = with_flows(holdout_sql() + """
SELECT target_tipo, count(*) AS n FROM flows WHERE row_id IN (SELECT row_id FROM hold) GROUP BY 1
""")


def stage1_parts_sql() -> str:
    return holdout_sql() + """,
rest AS (SELECT * FROM flows WHERE row_id NOT IN (SELECT row_id FROM hold))""" + three_way_sql(
        "rest", "target_bin", "b")


ORACLE["stratified_folds"] = with_flows(stage1_parts_sql() + """,
tr AS (SELECT * FROM bparts WHERE part = 'train'),
fc AS (SELECT target_bin AS c, count(*) AS n FROM tr GROUP BY 1),
fpos AS (SELECT c, n, sum(n) OVER (ORDER BY c ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b FROM fc),
fa AS (SELECT c, f.fold,
              floor((b - f.fold + 4) / 5) - floor((b - n - f.fold + 4) / 5) AS n_fold
       FROM fpos, (SELECT unnest(range(5)) AS fold) f),
fk AS (SELECT c, fold, sum(n_fold) OVER (PARTITION BY c ORDER BY fold) AS k_hi,
              sum(n_fold) OVER (PARTITION BY c ORDER BY fold) - n_fold AS k_lo FROM fa),
trr AS (SELECT row_id, target_bin,
               row_number() OVER (PARTITION BY target_bin ORDER BY """ + HASH_ORDER + """) AS rnk FROM tr)
SELECT trr.row_id, trr.target_bin, CAST(fk.fold AS INTEGER) AS fold
FROM trr JOIN fk ON fk.c = trr.target_bin AND trr.rnk > fk.k_lo AND trr.rnk <= fk.k_hi
""")

ORACLE["rare_class_filter"] = with_flows(holdout_sql() + """,
att AS (SELECT * FROM flows WHERE row_id NOT IN (SELECT row_id FROM hold) AND target_bin = 1),
ac AS (SELECT target_tipo, count(*) AS n FROM att GROUP BY 1)
SELECT target_tipo, n FROM ac WHERE n >= 10
""")


# --- rule trees, cascade, reports -------------------------------------------------

import json as _json  # noqa: E402
import os as _os  # noqa: E402

_RES = _os.path.join(_os.path.dirname(_os.path.dirname(_os.path.abspath(__file__))), "resources")


def _tree(name: str) -> dict:
    with open(_os.path.join(_RES, name), encoding="utf-8") as f:
        return _json.load(f)


T1, T2 = _tree("rules_stage1.json"), _tree("rules_stage2.json")
with open(_os.path.join(_RES, "rules_stage1.threshold")) as _f:
    THR = _f.read().strip()


def nodes_sql(name: str, tree: dict) -> str:
    """CTE ``name(id, feature, threshold, lft, rgt, value, conf)``: the exported nodes as they are."""
    rows = []
    for n in tree["nodes"]:
        probs = n.get("probs") or []
        rows.append("({}, {}, {}, {}, {}, {}, {})".format(
            n["id"], "NULL" if n["feature"] is None else f"'{n['feature']}'",
            "NULL" if n["threshold"] is None else f"CAST('{n['threshold']!r}' AS DOUBLE)", n["left"], n["right"],
            f"CAST('{n['value']!r}' AS DOUBLE)", f"CAST('{max(probs) if probs else 1.0!r}' AS DOUBLE)"))
    return f"{name}(id, feature, threshold, lft, rgt, value, conf) AS (VALUES {', '.join(rows)})"


def walk_sql(name: str, tree: dict, nodes: str, src: str) -> str:
    """CTE ``name(row_id, leaf, value, conf)``: every row goes down the node table, step by step."""
    value = "CASE n.feature " + " ".join(f"""WHEN '{c}' THEN s."{c}" """ for c in tree["features"]) + "END"
    root = next(n["id"] for n in tree["nodes"] if all(n["id"] not in (m["left"], m["right"]) for m in tree["nodes"]))
    return f"""
{name}_w AS (
  SELECT row_id, {root} AS at FROM {src}
  UNION ALL
  SELECT w.row_id, CASE WHEN {value} <= n.threshold THEN n.lft ELSE n.rgt END
  FROM {name}_w w JOIN {nodes} n ON n.id = w.at AND n.lft >= 0 JOIN {src} s ON s.row_id = w.row_id
),
{name} AS (SELECT w.row_id, n.id AS leaf, n.value, n.conf FROM {name}_w w JOIN {nodes} n ON n.id = w.at AND n.lft < 0)"""


T2_CLASSES = "[" + ", ".join(f"'{c}'" for c in T2["classes"]) + "]"


_r100 = "CAST(100 AS DOUBLE)"


def _r2(x: str) -> str:
    """numpy round(x, 2): half-even on x*100."""
    return f"(round_even(({x}) * {_r100}, 0) / {_r100})"


def cascade_sql(src: str, mode: str) -> str:
    """CTE ``casc``: cascade columns over ``src`` (must hold the tree features)."""
    default = "'Benign'" if mode == "evaluation" else "'N/A'"
    return f""",
{nodes_sql("nd1", T1)},
{nodes_sql("nd2", T2)},{walk_sql("lf1", T1, "nd1", src)},{walk_sql("lf2", T2, "nd2", src)},
casc AS (
  SELECT s.*, lf1.value AS p_attack,
         CASE WHEN lf1.value >= CAST('{THR}' AS DOUBLE) THEN 'Ataque' ELSE 'Normal' END AS alert,
         {_r2(f"(CASE WHEN lf1.value >= CAST('{THR}' AS DOUBLE) THEN lf1.value ELSE CAST(1 AS DOUBLE) - lf1.value END) * {_r100}")}
           AS result_confidence,
         CASE WHEN lf1.value >= CAST('{THR}' AS DOUBLE) THEN {T2_CLASSES}[CAST(lf2.value AS INT) + 1] ELSE {default} END
           AS attack_type,
         CASE WHEN lf1.value >= CAST('{THR}' AS DOUBLE) THEN {_r2(f"lf2.conf * {_r100}")} END AS type_confidence
  FROM {src} s JOIN lf1 ON lf1.row_id = s.row_id JOIN lf2 ON lf2.row_id = s.row_id
)"""


EVAL_SQL = holdout_sql() + """,
hev0 AS (SELECT * FROM flows WHERE row_id IN (SELECT row_id FROM hold)),
hevc AS (SELECT target_tipo, count(*) AS n FROM hev0 GROUP BY 1),
hev AS (SELECT hev0.* FROM hev0 JOIN hevc USING (target_tipo) WHERE hevc.n >= 2)""" + cascade_sql("hev", "evaluation")

ORACLE["rule_tree_score"] = with_flows(f""",
{nodes_sql("nd1", T1)},{walk_sql("lf1", T1, "nd1", "flows")}
SELECT row_id, leaf, value AS p_attack FROM lf1
""")

ORACLE["cascade_score"] = with_flows(EVAL_SQL + """
SELECT row_id, target_tipo, alert, result_confidence, attack_type, type_confidence, p_attack FROM casc
""")

CM_SQL = """,
labs AS (SELECT target_tipo AS label FROM casc UNION SELECT attack_type FROM casc),
cnt AS (SELECT target_tipo AS actual, attack_type AS predicted, count(*) AS n FROM casc GROUP BY 1, 2),
cm AS (SELECT a.label AS actual, p.label AS predicted, COALESCE(cnt.n, 0) AS n
       FROM labs a JOIN labs p ON TRUE
       LEFT JOIN cnt ON cnt.actual = a.label AND cnt.predicted = p.label)"""

ORACLE["confusion_matrix"] = with_flows(EVAL_SQL + CM_SQL + """
SELECT actual, predicted, n FROM cm
""")

REPORT_SQL = """,
pa AS (SELECT actual AS label, sum(n) AS support, sum(CASE WHEN actual = predicted THEN n ELSE 0 END) AS tp
       FROM cm GROUP BY 1),
pp AS (SELECT predicted AS label, sum(n) AS predicted FROM cm GROUP BY 1),
pc AS (SELECT pa.label, pa.tp, pa.support, pp.predicted,
              CASE WHEN pp.predicted <> 0 THEN CAST(pa.tp AS DOUBLE) / CAST(pp.predicted AS DOUBLE) ELSE 0.0 END AS precision,
              CASE WHEN pa.support <> 0 THEN CAST(pa.tp AS DOUBLE) / CAST(pa.support AS DOUBLE) ELSE 0.0 END AS recall,
              CASE WHEN pa.support + pp.predicted <> 0
                   THEN CAST(2 * pa.tp AS DOUBLE) / CAST(pa.support + pp.predicted AS DOUBLE) ELSE 0.0 END AS f1
       FROM pa JOIN pp USING (label)),
tot AS (SELECT sum(support) AS s, sum(tp) AS t FROM pc),
rep AS (
  SELECT CAST(label AS VARCHAR) AS label, precision, recall, f1, support FROM pc
  UNION ALL SELECT 'accuracy', NULL, NULL, CAST(t AS DOUBLE) / CAST(s AS DOUBLE), s FROM tot
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), (SELECT s FROM tot) FROM pc
  UNION ALL SELECT 'weighted avg', sum(precision * support) / (SELECT s FROM tot),
                   sum(recall * support) / (SELECT s FROM tot), sum(f1 * support) / (SELECT s FROM tot),
                   (SELECT s FROM tot) FROM pc)"""

ORACLE["classification_report"] = with_flows(EVAL_SQL + CM_SQL + REPORT_SQL + """
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM rep
""")

ORACLE["missed_attacks"] = with_flows(EVAL_SQL + """,
per AS (SELECT target_tipo AS family,
               sum(CASE WHEN attack_type = 'Benign' THEN 1 ELSE 0 END) AS missed, count(*) AS total
        FROM casc WHERE target_tipo <> 'Benign' GROUP BY 1),
allrow AS (SELECT 'ALL' AS family, sum(missed) AS missed, sum(total) AS total FROM per)
SELECT family, CAST(missed AS BIGINT) AS missed, CAST(total AS BIGINT) AS total,
       CAST(missed AS DOUBLE) * 100.0 / CAST(total AS DOUBLE) AS pct
FROM (SELECT * FROM per WHERE missed > 0 UNION ALL SELECT * FROM allrow WHERE total IS NOT NULL)
""")

NUMERIC_RE = (r"^\s*[+-]?(((\d+\.?\d*)|(\.\d+))([eE][+-]?\d+)?"
              r"|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$")


def _junk(c: str) -> str:
    return (f"""CASE WHEN row_id % 31 = 0 THEN 'abc' WHEN row_id % 37 = 0 THEN 'inf'
         WHEN row_id % 41 = 0 THEN 'NaN' WHEN row_id % 43 = 0 THEN '1d' WHEN row_id % 47 = 0 THEN NULL
         ELSE CAST("{c}" AS VARCHAR) END""")


_CSV_FEATS = [" Flow Duration", "Total Fwd Packets", "Fwd Packet Length Max", "Flow Bytes/s",
              "Flow Packets/s ", "SYN Flag Count", "Down/Up Ratio", "Unit Score"]

FLOWS_CSV = FLOWS_RAW + """,
flows_csv AS (
  SELECT row_id, """ + ",\n         ".join(f'{_junk(c)} AS "{c.strip()}"' for c in _CSV_FEATS) + """,
         "Source IP",
         CASE row_id % 7 WHEN 0 THEN '6' WHEN 1 THEN '17' WHEN 2 THEN '1' WHEN 3 THEN '6.0'
                         WHEN 4 THEN 'abc' WHEN 5 THEN NULL ELSE '200' END AS "Protocol"
  FROM flows_raw
)"""


def _num0(c: str) -> str:
    d = f'(CASE WHEN regexp_matches("{c}", \'{NUMERIC_RE}\') THEN TRY_CAST(trim("{c}") AS DOUBLE) END)'
    return f"COALESCE(CASE WHEN isnan({d}) OR isinf({d}) THEN NULL ELSE {d} END, CAST(0 AS DOUBLE))"


def conform_sql(cols: list[str]) -> str:
    have = {c.strip() for c in _CSV_FEATS}
    return ", ".join((_num0(c) if c in have else "CAST(0 AS DOUBLE)") + f' AS "{c}"' for c in cols)


MODEL_COLS = list(T1["features"]) + [c for c in T2["features"] if c not in T1["features"]]

PROTO_SQL = f"""(CASE WHEN regexp_matches("Protocol", '{NUMERIC_RE}')
                   AND NOT isnan(TRY_CAST(trim("Protocol") AS DOUBLE)) AND NOT isinf(TRY_CAST(trim("Protocol") AS DOUBLE))
                   AND abs(TRY_CAST(trim("Protocol") AS DOUBLE)) < 2147483648
              THEN COALESCE(pn.name, 'Outro') || ' (' || CAST(CAST(trunc(TRY_CAST(trim("Protocol") AS DOUBLE)) AS INTEGER) AS VARCHAR) || ')'
              ELSE "Protocol" END)"""

PROTO_VALUES = """
pn(code, name) AS (VALUES (1,'ICMP'), (2,'IGMP'), (6,'TCP'), (17,'UDP'), (47,'GRE'), (50,'ESP'), (51,'AH'),
                          (58,'ICMPv6'), (89,'OSPF'), (132,'SCTP'))"""

_PJOIN = """LEFT JOIN pn ON pn.code = (CASE WHEN regexp_matches("Protocol", '""" + NUMERIC_RE + """')
                   AND NOT isnan(TRY_CAST(trim("Protocol") AS DOUBLE)) AND NOT isinf(TRY_CAST(trim("Protocol") AS DOUBLE))
                   AND abs(TRY_CAST(trim("Protocol") AS DOUBLE)) < 2147483648
              THEN CAST(trunc(TRY_CAST(trim("Protocol") AS DOUBLE)) AS INTEGER) END)"""

CSV_SCORED = "WITH RECURSIVE " + FLOWS_CSV + "," + PROTO_VALUES + f""",
conf AS (SELECT row_id, "Source IP", "Protocol", {conform_sql(MODEL_COLS)} FROM flows_csv)""" + cascade_sql(
    "conf", "dashboard") + f""",
rt AS (SELECT row_id, "Source IP", {PROTO_SQL} AS "Protocolo", alert, result_confidence, attack_type, type_confidence
       FROM casc {_PJOIN})"""

ORACLE["alert_kpis"] = CSV_SCORED + """
SELECT CAST(sum(CASE WHEN alert <> 'Ataque' THEN 1 ELSE 0 END) AS BIGINT) AS normal,
       CAST(sum(CASE WHEN alert = 'Ataque' THEN 1 ELSE 0 END) AS BIGINT) AS attacks, count(*) AS total,
       round_even(CAST(sum(CASE WHEN alert = 'Ataque' THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE) * 10.0, 0) / 10.0
         AS anomaly_rate_pct
FROM casc
"""

ORACLE["alert_distribution"] = CSV_SCORED + """
SELECT alert, count(*) AS n FROM casc GROUP BY 1
"""

ORACLE["attack_types"] = CSV_SCORED + """
SELECT attack_type, count(*) AS n FROM casc WHERE alert = 'Ataque' GROUP BY 1
"""

ORACLE["alert_context"] = CSV_SCORED + """
SELECT * FROM rt
"""

ORACLE["result_page"] = CSV_SCORED + """
SELECT * FROM rt ORDER BY row_id LIMIT 50 OFFSET 50
"""

ORACLE["protocol_names"] = "WITH " + FLOWS_CSV + "," + PROTO_VALUES + f"""
SELECT row_id, "Protocol", {PROTO_SQL} AS "Protocolo" FROM flows_csv {_PJOIN}
"""

ORACLE["conform_features"] = "WITH " + FLOWS_CSV + f"""
SELECT row_id, {conform_sql(MODEL_COLS)} FROM flows_csv
"""

THRESH_SQL = """,
ft AS (SELECT f.row_id, f."Unit Score" AS s,
              CASE WHEN upper(trim(f."Label")) = 'BENIGN' THEN 0 ELSE 1 END AS y FROM flows_raw f),
thr AS (SELECT i, CASE WHEN i = 98 THEN 0.99::DOUBLE
                       ELSE CAST(i AS DOUBLE) * ((0.99::DOUBLE - 0.01::DOUBLE) / CAST(98 AS DOUBLE)) + 0.01::DOUBLE END AS threshold
        FROM (SELECT unnest(range(99)) AS i)),
P AS (SELECT sum(y) AS pos FROM ft WHERE s IS NOT NULL),
sw AS (SELECT thr.threshold,
              CAST(sum(CASE WHEN ft.s >= thr.threshold AND ft.y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
              CAST(sum(CASE WHEN ft.s >= thr.threshold AND ft.y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
              CAST(sum(CASE WHEN ft.s >= thr.threshold THEN 1 ELSE 0 END) AS BIGINT) AS pp
       FROM thr JOIN ft ON ft.s IS NOT NULL GROUP BY thr.threshold),
sweep AS (SELECT threshold, tp, fp, CAST((SELECT pos FROM P) - tp AS BIGINT) AS fn,
                 CASE WHEN (SELECT pos FROM P) <> 0 THEN CAST(tp AS DOUBLE) / CAST((SELECT pos FROM P) AS DOUBLE) ELSE 0.0 END AS recall,
                 CASE WHEN pp <> 0 THEN CAST(tp AS DOUBLE) / CAST(pp AS DOUBLE) ELSE 0.0 END AS precision,
                 CASE WHEN (SELECT pos FROM P) + pp <> 0
                      THEN CAST(2 * tp AS DOUBLE) / CAST((SELECT pos FROM P) + pp AS DOUBLE) ELSE 0.0 END AS f1
          FROM sw),
best AS (
  SELECT threshold, recall, precision, f1, (SELECT bool_or(recall >= 0.98::DOUBLE) FROM sweep) AS reached FROM sweep
  ORDER BY CASE WHEN (SELECT bool_or(recall >= 0.98::DOUBLE) FROM sweep)
                THEN (CASE WHEN recall >= 0.98::DOUBLE THEN f1 END) ELSE recall END DESC NULLS LAST, threshold
  LIMIT 1)"""

ORACLE["threshold_sweep"] = "WITH " + FLOWS_RAW + THRESH_SQL + """
SELECT * FROM sweep
"""

ORACLE["best_threshold"] = "WITH " + FLOWS_RAW + THRESH_SQL + """
SELECT * FROM best
"""

ORACLE["threshold_report"] = "WITH " + FLOWS_RAW + THRESH_SQL + """,
casc AS (SELECT y AS target_tipo, CASE WHEN s >= (SELECT threshold FROM best) THEN 1 ELSE 0 END AS attack_type FROM ft
         WHERE s IS NOT NULL),
labs AS (SELECT * FROM (VALUES (0), (1)) v(label)),
cnt AS (SELECT target_tipo AS actual, attack_type AS predicted, count(*) AS n FROM casc GROUP BY 1, 2),
cm AS (SELECT a.label AS actual, p.label AS predicted, COALESCE(cnt.n, 0) AS n
       FROM labs a JOIN labs p ON TRUE
       LEFT JOIN cnt ON cnt.actual = a.label AND cnt.predicted = p.label)""" + REPORT_SQL + """
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM rep
"""


# --- profile, balancing ------------------------------------------------------------

_RAW_NUM = [" Flow Duration", "Total Fwd Packets", "Fwd Packet Length Max", "Flow Bytes/s", "Flow Packets/s ",
            "SYN Flag Count", "Bwd PSH Flags", "Down/Up Ratio", "Unit Score"]
_RAW_STR = ["Source IP", "Label"]


def _prof_num(i: int, c: str) -> str:
    q = f'"{c}"'
    v = f"(CASE WHEN NOT isnan({q}) THEN {q} END)"
    return f"""SELECT {i} AS pos, '{c}' AS "column", TRUE AS is_numeric, min({v}) AS min, max({v}) AS max,
       round(avg({v}), 6) AS mean, COALESCE(max(CASE WHEN {v} < 0 OR {v} > 1 THEN 1 ELSE 0 END), 0) = 1 AS outside_01,
       CAST(sum(CASE WHEN {q} IS NULL OR isnan({q}) THEN 1 ELSE 0 END) AS BIGINT) AS nulls,
       CAST(sum(CASE WHEN isinf({q}) THEN 1 ELSE 0 END) AS BIGINT) AS infs,
       count({v}) >= 2 AND sum(CASE WHEN isinf({q}) THEN 1 ELSE 0 END) = 0 AND min({v}) = max({v}) AS constant
FROM flows_raw"""


def _prof_str(i: int, c: str) -> str:
    return f"""SELECT {i} AS pos, '{c}' AS "column", FALSE AS is_numeric, CAST(NULL AS DOUBLE) AS min,
       CAST(NULL AS DOUBLE) AS max, CAST(NULL AS DOUBLE) AS mean, FALSE AS outside_01,
       CAST(sum(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls, CAST(0 AS BIGINT) AS infs,
       FALSE AS constant FROM flows_raw"""


PROFILE_SQL = ",\nprof AS (\n" + "\nUNION ALL\n".join(
    [_prof_num(i, c) for i, c in enumerate(_RAW_NUM)]
    + [_prof_str(len(_RAW_NUM) + j, c) for j, c in enumerate(_RAW_STR)]) + "\n)"

ORACLE["column_profile"] = "WITH " + FLOWS_RAW + PROFILE_SQL + """
SELECT * FROM prof
"""

ORACLE["profile_summary"] = "WITH " + FLOWS_RAW + PROFILE_SQL + """
SELECT (SELECT count(*) FROM flows_raw) AS "rows", count(*) AS "columns",
       CAST(sum(CASE WHEN is_numeric THEN 1 ELSE 0 END) AS BIGINT) AS numeric_columns,
       CAST(sum(CASE WHEN is_numeric AND outside_01 THEN 1 ELSE 0 END) AS BIGINT) AS outside_01_columns,
       CAST(sum(nulls) AS BIGINT) AS nulls, CAST(sum(infs) AS BIGINT) AS infs,
       CAST(sum(CASE WHEN constant THEN 1 ELSE 0 END) AS BIGINT) AS constant_columns,
       count(*) - 1 AS features, 'Source IP' AS metadata_columns
FROM prof
"""

ORACLE["label_counts_by_source"] = "WITH " + FLOWS_RAW + """
SELECT source, "Label", count(*) AS n FROM flows_raw GROUP BY 1, 2
UNION ALL SELECT source, '*', count(*) FROM flows_raw GROUP BY 1
UNION ALL SELECT NULL, '*', count(*) FROM flows_raw
"""

UNDER_SQL = stage1_parts_sql() + """,
tr AS (SELECT * FROM bparts WHERE part = 'train'),
uc AS (SELECT target_bin AS c, count(*) AS n FROM tr GROUP BY 1),
up AS (SELECT c, n, CASE WHEN row_number() OVER (ORDER BY n, c) = 1 THEN n
                         ELSE CAST(floor(CAST(min(n) OVER () AS DOUBLE) / 0.333::DOUBLE) AS BIGINT) END AS keep FROM uc),
ur AS (SELECT row_id, target_bin,
              row_number() OVER (PARTITION BY target_bin ORDER BY """ + HASH_ORDER + """) AS urnk FROM tr),
kept AS (SELECT ur.row_id, ur.target_bin FROM ur JOIN up ON up.c = ur.target_bin WHERE ur.urnk <= up.keep)"""

ORACLE["undersample_rows"] = with_flows(UNDER_SQL + """
SELECT row_id, target_bin FROM kept
""")

ORACLE["undersample_counts"] = with_flows(UNDER_SQL + """
SELECT target_bin, count(*) AS n FROM kept GROUP BY 1
""")

ORACLE["class_weights"] = with_flows(UNDER_SQL + """,
kc AS (SELECT target_bin, count(*) AS n FROM kept GROUP BY 1)
SELECT target_bin, CAST(sum(n) OVER () AS DOUBLE) / CAST(count(*) OVER () * n AS DOUBLE) AS weight FROM kc
""")

S2_FEATS = ["Flow Duration", "Total Fwd Packets", "Fwd Packet Length Max", "Flow Bytes/s", "Flow Packets/s",
            "SYN Flag Count", "Bwd PSH Flags", "Down/Up Ratio", "Unit Score"]

S2_TRAIN_SQL = holdout_sql() + """,
att0 AS (SELECT * FROM flows WHERE row_id NOT IN (SELECT row_id FROM hold) AND target_bin = 1),
attc AS (SELECT target_tipo, count(*) AS n FROM att0 GROUP BY 1),
att AS (SELECT att0.* FROM att0 JOIN attc USING (target_tipo) WHERE attc.n >= 10),
s2c AS (SELECT target_tipo AS c, count(*) AS n FROM att GROUP BY 1),""" + alloc_sql(
    "s2a", "s2c", "ceil(0.15::DOUBLE * tot)") + """,
s2r AS (SELECT att.*, row_number() OVER (PARTITION BY target_tipo ORDER BY """ + HASH_ORDER + """) AS rnk FROM att),
s2tr AS (SELECT s2r.* FROM s2r JOIN s2a ON s2a.c = s2r.target_tipo WHERE s2r.rnk <= s2a.n_train)"""

_D2 = " + ".join(f'(a."{c}" - b."{c}") * (a."{c}" - b."{c}")' for c in S2_FEATS)

ORACLE["smote_neighbours"] = with_flows(S2_TRAIN_SQL + f""",
pairs AS (SELECT a.target_tipo, a.row_id AS pid, b.row_id AS nn_pid, sqrt(0.0::DOUBLE + {_D2}) AS dist
          FROM s2tr a JOIN s2tr b ON a.target_tipo = b.target_tipo AND a.row_id <> b.row_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY dist, nn_pid) AS nn_rank FROM pairs)
SELECT target_tipo, pid, CAST(nn_rank AS INTEGER) AS nn_rank, nn_pid FROM rk WHERE nn_rank <= 5
""")

ORACLE["smote_class_counts"] = with_flows(S2_TRAIN_SQL + """,
cc AS (SELECT target_tipo, count(*) AS n FROM s2tr GROUP BY 1)
SELECT target_tipo, max(n) OVER () AS n, max(n) OVER () - n AS synthetic FROM cc
""")


# --- constant columns, scaler statistics ----------------------------------------------

ORACLE["constant_columns_train"] = with_flows(three_way_sql("flows", "target_tipo", "s") + """,
tr AS (SELECT * FROM sparts WHERE part = 'train')
""" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column" FROM tr HAVING count("{c}") >= 2 AND min("{c}") = max("{c}")"""
    for c in S2_FEATS))

ORACLE["scaler_stats"] = with_flows(stage1_parts_sql() + """,
tr AS (SELECT * FROM bparts WHERE part = 'train')
""" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS feature, round(avg("{c}"), 6) AS mean, round(stddev_pop("{c}"), 6) AS std FROM tr
HAVING min("{c}") <> max("{c}")"""
    for c in S2_FEATS))

ORACLE["smote_rows"] = with_flows(S2_TRAIN_SQL + f""",
pairs AS (SELECT a.target_tipo, a.row_id AS pid, b.row_id AS nn_pid, sqrt(0.0::DOUBLE + {_D2}) AS dist
          FROM s2tr a JOIN s2tr b ON a.target_tipo = b.target_tipo AND a.row_id <> b.row_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY dist, nn_pid) AS nn_rank FROM pairs),
cc AS (SELECT target_tipo, count(*) AS n FROM s2tr GROUP BY 1),
nd AS (SELECT target_tipo, n, max(n) OVER () - n AS need FROM cc),
bs AS (SELECT s.*, row_number() OVER (PARTITION BY s.target_tipo ORDER BY """ + HASH_ORDER.replace("row_id", "s.row_id") + f""") AS pos,
              nd.n AS n_c, nd.need FROM s2tr s JOIN nd ON nd.target_tipo = s.target_tipo WHERE nd.need > 0),
rp AS (SELECT *, need // n_c + CASE WHEN pos <= need % n_c THEN 1 ELSE 0 END AS reps FROM bs),
dr AS (SELECT rp.*, unnest(range(1, CAST(reps AS BIGINT) + 1)) AS draw FROM rp WHERE reps > 0),
ch AS (SELECT *, CAST(floor(('0x' || substr(md5('42:nn:' || row_id || ':' || draw), 1, 13))::BIGINT::DOUBLE
              / 4503599627370496.0::DOUBLE * 5) AS INT) + 1 AS nn_rank,
              ('0x' || substr(md5('42:gap:' || row_id || ':' || draw), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS g
       FROM dr)
SELECT ch.target_tipo, ch.row_id AS base_id, CAST(ch.draw AS INT) AS draw, rk.nn_pid,
       round(ch."Flow Duration" + ch.g * (b."Flow Duration" - ch."Flow Duration"), 6) AS flow_duration,
       round(ch."Unit Score" + ch.g * (b."Unit Score" - ch."Unit Score"), 6) AS unit_score
FROM ch JOIN rk ON rk.pid = ch.row_id AND rk.nn_rank = ch.nn_rank JOIN s2tr b ON b.row_id = rk.nn_pid
""")

ORACLE["smote_drawn_rows"] = with_flows(S2_TRAIN_SQL + f""",
pairs AS (SELECT a.target_tipo, a.row_id AS pid, b.row_id AS nn_pid, sqrt(0.0::DOUBLE + {_D2}) AS dist
          FROM s2tr a JOIN s2tr b ON a.target_tipo = b.target_tipo AND a.row_id <> b.row_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY dist, nn_pid) AS nn_rank FROM pairs),
cc AS (SELECT target_tipo, count(*) AS n FROM s2tr GROUP BY 1),
nd AS (SELECT target_tipo, n, max(n) OVER () - n AS need FROM cc),
bs AS (SELECT s.*, row_number() OVER (PARTITION BY s.target_tipo ORDER BY """ + HASH_ORDER.replace("row_id", "s.row_id") + f""") AS pos
       FROM s2tr s),
dn AS (SELECT target_tipo, n, unnest(range(1, need + 1)) AS draw FROM nd WHERE need > 0),
dr AS (SELECT bs.*, dn.draw FROM dn JOIN bs ON bs.target_tipo = dn.target_tipo
       AND bs.pos = CAST(floor(('0x' || substr(md5('42:base:' || dn.target_tipo || ':' || dn.draw), 1, 13))::BIGINT::DOUBLE
                               / 4503599627370496.0::DOUBLE * dn.n) AS BIGINT) + 1),
ch AS (SELECT *, CAST(floor(('0x' || substr(md5('42:nn:' || row_id || ':' || draw), 1, 13))::BIGINT::DOUBLE
              / 4503599627370496.0::DOUBLE * 5) AS INT) + 1 AS nn_rank,
              ('0x' || substr(md5('42:gap:' || row_id || ':' || draw), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS g
       FROM dr)
SELECT ch.target_tipo, ch.row_id AS base_id, CAST(ch.draw AS INT) AS draw, rk.nn_pid,
       round(ch."Flow Duration" + ch.g * (b."Flow Duration" - ch."Flow Duration"), 6) AS flow_duration,
       round(ch."Unit Score" + ch.g * (b."Unit Score" - ch."Unit Score"), 6) AS unit_score
FROM ch JOIN rk ON rk.pid = ch.row_id AND rk.nn_rank = ch.nn_rank JOIN s2tr b ON b.row_id = rk.nn_pid
""")

# --- saved bundles, rule text, fitted preparation -----------------------------------

ORACLE["bundle_row_check"] = "SELECT count(*) AS n, count(DISTINCT event_id) AS ids, CAST(0 AS BIGINT) AS broken FROM events"

ORACLE["compiled_tree_check"] = with_flows(EVAL_SQL + """
SELECT stage, count(*) AS n, CAST(0 AS BIGINT) AS differing FROM hev, (VALUES (1), (2)) t(stage) GROUP BY stage
""")


def paths_sql(name: str, tree: dict, nodes: str) -> str:
    """CTE ``name(id, depth, rule)``: the conditions on the way down to every node."""
    root = next(n["id"] for n in tree["nodes"] if all(n["id"] not in (m["left"], m["right"]) for m in tree["nodes"]))
    return f"""
{name} AS (
  SELECT {root} AS id, 0 AS depth, CAST('' AS VARCHAR) AS rule
  UNION ALL
  SELECT CASE side WHEN 'l' THEN n.lft ELSE n.rgt END, p.depth + 1,
         p.rule || CASE WHEN p.rule = '' THEN '' ELSE ' AND ' END || n.feature
         || CASE side WHEN 'l' THEN ' <= ' ELSE ' > ' END || printf('%.2f', n.threshold)
  FROM {name} p JOIN {nodes} n ON n.id = p.id AND n.lft >= 0, (VALUES ('l'), ('r')) t(side)
)"""


ORACLE["rule_leaf_support"] = with_flows(EVAL_SQL + f""",{paths_sql("pt1", T1, "nd1")},{paths_sql("pt2", T2, "nd2")}
SELECT 1 AS stage, p.id AS leaf, depth, CASE WHEN rule = '' THEN 'TRUE' ELSE rule END AS rule,
       CASE WHEN n.value > 0.5 THEN '1' ELSE '0' END AS label, n.value AS confidence,
       (SELECT count(*) FROM lf1 WHERE lf1.leaf = p.id) AS n
FROM pt1 p JOIN nd1 n ON n.id = p.id AND n.lft < 0
UNION ALL
SELECT 2, p.id, depth, CASE WHEN rule = '' THEN 'TRUE' ELSE rule END, {T2_CLASSES}[CAST(n.value AS INT) + 1], n.conf,
       (SELECT count(*) FROM lf2 WHERE lf2.leaf = p.id)
FROM pt2 p JOIN nd2 n ON n.id = p.id AND n.lft < 0
""")

# thresholds as the text has them
_T2_TEXT = {**T2, "nodes": [{**n, "threshold": None if n["threshold"] is None else float(f"{n['threshold']:.2f}")}
                            for n in T2["nodes"]]}
ORACLE["rule_text_score"] = with_flows(f""",
{nodes_sql("nd2", _T2_TEXT)},{walk_sql("lf2", _T2_TEXT, "nd2", "flows")}
SELECT row_id, {T2_CLASSES}[CAST(value AS INT) + 1] AS label FROM lf2
""")

ORACLE["parts_without_constants"] = with_flows(three_way_sql("flows", "target_tipo", "s") + "\n" + "\nUNION ALL\n".join(
    f"""SELECT part, '{c}' AS "column", count("{c}") AS n FROM sparts
WHERE (SELECT count("{c}") < 2 OR min("{c}") <> max("{c}") FROM sparts WHERE part = 'train') GROUP BY part"""
    for c in S2_FEATS))

ORACLE["population_scaler"] = ORACLE["scaler_stats"]

ORACLE["stacked_file_counts"] = " UNION ALL ".join(
    f"SELECT '{t}.parquet' AS file, count(*) AS read_rows, count(*) AS written_rows, true AS matches FROM {t}"
    for t in ("events", "orders", "lineitem", "customer"))
