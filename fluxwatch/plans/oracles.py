"""The registered queries in SQL, over the driver's tables as views."""

from __future__ import annotations

from fluxwatch.plans.views import FOREST_LABELS, FOREST_NODES
from fluxwatch.schemas import FEATURES

_EVENTS = """
e AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         epoch_us(ts) - 1704067200000000 AS off
  FROM events)"""

_PACKETS = f"""{_EVENTS},
packets AS (
  SELECT event_id % 4 AS run_id,
         user_id % 50 + off / CASE user_id % 5 WHEN 0 THEN 2e14::DOUBLE WHEN 1 THEN 3e13::DOUBLE
                                               WHEN 2 THEN 1e11::DOUBLE ELSE 2e13::DOUBLE END AS timestamp_s,
         user_id AS flow_id,
         CAST(9000 + user_id AS INTEGER) AS port,
         CAST(CASE user_id % 5 WHEN 0 THEN 1024 WHEN 1 THEN 1400 WHEN 2 THEN 64 ELSE 512 END + k % 8
              AS BIGINT) AS packet_size_bytes,
         CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'tx' ELSE 'rx' END AS direction,
         CASE user_id % 5 WHEN 0 THEN 'FLOOD' WHEN 1 THEN 'BURST' WHEN 2 THEN 'STEALTH' ELSE 'Normal' END AS attack_type,
         user_id % 2 = 0 AS pqc_enabled,
         0.1::DOUBLE + user_id / 1000.0::DOUBLE AS kem_handshake_ms,
         0.2::DOUBLE + user_id / 500.0::DOUBLE AS sig_sign_ms,
         0.05::DOUBLE + user_id / 2000.0::DOUBLE AS sig_verify_ms
  FROM e)"""

_RULES = """CASE
  WHEN flow_bytes_s > 2000000 OR flow_packets_s > 4000 THEN 'FLOOD'
  WHEN flow_bytes_s > 500000 AND flow_iat_std > flow_iat_mean * 0.3::DOUBLE THEN 'BURST'
  WHEN flow_bytes_s < 5000 AND flow_packets_s < 100 AND fwd_pkt_len_mean < 100 THEN 'STEALTH'
  ELSE 'Normal' END"""

_SEVERITY = """CASE
  WHEN flow_bytes_s > 50000000 OR flow_packets_s > 50000 THEN 'CRITICAL'
  WHEN flow_bytes_s > 10000000 OR flow_packets_s > 20000 THEN 'HIGH'
  WHEN flow_bytes_s > 1000000 OR flow_packets_s > 5000 THEN 'MEDIUM'
  ELSE 'LOW' END"""

_LABEL_SEVERITY = """CASE attack_type WHEN 'FLOOD' THEN 'CRITICAL' WHEN 'BURST' THEN 'HIGH'
  WHEN 'STEALTH' THEN 'MEDIUM' ELSE 'LOW' END"""

_FLOWS = f"""
raw_flows AS (
  SELECT CAST(l_orderkey AS INTEGER) AS flow_id,
         '10.1.' || (l_suppkey % 200) || '.1' AS src_ip,
         '10.2.' || (l_partkey % 200) || '.2' AS dst_ip,
         CAST(9000 + l_orderkey % 200 AS INTEGER) AS dst_port,
         l_extendedprice * l_quantity * l_quantity / 50.0::DOUBLE AS flow_bytes_s,
         l_quantity * 90.0::DOUBLE AS flow_packets_s,
         l_discount AS flow_iat_mean, l_tax AS flow_iat_std,
         40.0::DOUBLE + l_quantity * 20.0::DOUBLE AS fwd_pkt_len_mean,
         l_linenumber % 2 = 0 AS pqc_enabled,
         0.1::DOUBLE + l_linenumber / 8.0::DOUBLE AS kem_handshake_ms,
         0.2::DOUBLE + l_linenumber / 4.0::DOUBLE AS sig_sign_ms,
         l_linestatus AS status
  FROM lineitem),
flows AS (SELECT *, {_RULES} AS attack_type, {_SEVERITY} AS severity FROM raw_flows)"""

_TIMED_COLUMNS = """
         CAST(event_id AS INTEGER) AS flow_id,
         '10.1.' || (user_id % 200) || '.1' AS src_ip,
         '10.2.' || (event_id % 200) || '.2' AS dst_ip,
         CAST(9000 + user_id % 100 AS INTEGER) AS dst_port,
         1704067200000000 + off // 10000 AS event_us,
         (1704067200000000 + off // 10000) // 1000 AS event_ms,
         k * 50.0::DOUBLE AS flow_packets_s,
         1.0::DOUBLE + user_id % 7 AS flow_iat_mean,
         event_id % 5 * 0.5::DOUBLE AS flow_iat_std,
         40.0::DOUBLE + k * 10.0::DOUBLE AS fwd_pkt_len_mean,
         k % 2 = 0 AS pqc_enabled,
         0.1::DOUBLE + k / 1000.0::DOUBLE AS kem_handshake_ms,
         0.2::DOUBLE + k / 500.0::DOUBLE AS sig_sign_ms"""


def _timed(rate: str = "value * value * 100.0::DOUBLE", only: str = "TRUE") -> str:
    return f"""{_EVENTS},
raw_timed AS (SELECT {_TIMED_COLUMNS}, {rate} AS flow_bytes_s FROM e WHERE {only}),
timed AS (SELECT *, {_RULES} AS attack_type, {_SEVERITY} AS severity FROM raw_timed)"""


_TIMED = _timed()
# messages: every tenth is broken, every tenth from the third on has no rate
_DECODED = _timed("CASE WHEN event_id % 10 = 3 THEN 0.0::DOUBLE ELSE value * value * 100.0::DOUBLE END", "event_id % 10 <> 0")

_ALERT_COLUMNS = """flow_id AS "flowId", attack_type AS "attackType", severity, src_ip AS "srcIp",
  dst_ip AS "dstIp", flow_bytes_s AS "flowBytesPerSec", flow_packets_s AS "flowPacketsPerSec",
  pqc_enabled AS "pqcEnabled", kem_handshake_ms AS "kemHandshakeMs",
  attack_type || ' attack detected from ' || src_ip || '→' || dst_ip || '! Severity: ' || severity ||
  ', Bytes/s: ' || CAST(CAST(round(flow_bytes_s) AS BIGINT) AS VARCHAR) || ', PQC: ' ||
  CASE WHEN pqc_enabled THEN 'ON' ELSE 'OFF' END AS message"""


def _feature_sql(key: str) -> str:
    return f"""WITH {_PACKETS},
g AS (SELECT *, timestamp_s - lag(timestamp_s) OVER (PARTITION BY {key} ORDER BY timestamp_s) AS iat FROM packets),
f AS (SELECT {key}, max(timestamp_s) - min(timestamp_s) AS d, count(*) AS n, sum(packet_size_bytes) AS b,
        avg(iat) AS im, stddev_samp(iat) AS isd, max(iat) AS ix, min(iat) AS ii,
        avg(packet_size_bytes) AS lm, stddev_samp(packet_size_bytes) AS lsd,
        max(packet_size_bytes) AS lx, min(packet_size_bytes) AS li,
        min(attack_type) AS label, bool_and(pqc_enabled) AS pqc, min(kem_handshake_ms) AS kem,
        min(sig_sign_ms) AS sgn, min(sig_verify_ms) AS ver
      FROM g GROUP BY {key})
SELECT {key}, round(b / greatest(d, 0.001::DOUBLE), 3) AS "Flow_Bytes_s", round(n / greatest(d, 0.001::DOUBLE), 3) AS "Flow_Packets_s",
  round(coalesce(im, 0), 9) AS "Flow_IAT_Mean", round(coalesce(isd, 0), 9) AS "Flow_IAT_Std",
  round(coalesce(ix, 0), 9) AS "Flow_IAT_Max", round(coalesce(ii, 0), 9) AS "Flow_IAT_Min",
  round(lm, 6) AS "Fwd_Pkt_Len_Mean", round(coalesce(lsd, 0), 6) AS "Fwd_Pkt_Len_Std",
  lx AS "Fwd_Pkt_Len_Max", li AS "Fwd_Pkt_Len_Min",
  round(d, 9) AS "Flow_Duration", n AS "Total_Fwd_Packets",
  kem AS "KEM_Handshake_ms", sgn AS "SIG_Sign_ms", ver AS "SIG_Verify_ms", label, pqc
FROM f"""


def _stats_sql(source: str, group: str = "", lead: str = "") -> str:
    """Statistics of labelled rows; ``lead`` selects what ``group`` groups by."""
    return f"""SELECT {lead} count(*) AS "totalFlows",
  count(*) FILTER (attack_type <> 'Normal') AS "attackFlows",
  count(*) FILTER (attack_type = 'Normal') AS "normalFlows",
  round(avg(flow_bytes_s), 4) AS "avgBytesPerSec", round(avg(flow_packets_s), 9) AS "avgPacketsPerSec",
  greatest(max(flow_bytes_s), 0.0::DOUBLE) AS "maxBytesPerSec",
  count(*) FILTER (attack_type <> 'Normal') / count(*) * 100.0::DOUBLE AS "attackRate",
  round(avg(kem_handshake_ms), 9) AS "avgKemHandshakeMs", round(avg(sig_sign_ms), 9) AS "avgSigSignMs",
  count(*) FILTER (attack_type = 'FLOOD') AS n_flood,
  count(*) FILTER (attack_type = 'STEALTH') AS n_stealth,
  count(*) FILTER (attack_type = 'BURST') AS n_burst
FROM {source} {group}"""


_WINDOW_STATS = f"""WITH {_TIMED},
w AS (SELECT * REPLACE (floor(flow_bytes_s) AS flow_bytes_s), event_us // 10000000 * 10000 AS ws FROM timed)
{_stats_sql('w', 'GROUP BY ws', 'ws AS "windowStart", ws + 10000 AS "windowEnd",')}"""


def _bandwidth(key: str = "") -> str:
    lead = f"{key}, " if key else ""
    return f"""
bw AS (SELECT {lead}CAST(trunc(timestamp_s) AS BIGINT) AS time_bucket,
    CAST(coalesce(sum(packet_size_bytes) FILTER (direction = 'tx'), 0) AS BIGINT) AS tx_bytes_per_sec,
    CAST(coalesce(sum(packet_size_bytes) FILTER (direction = 'rx'), 0) AS BIGINT) AS rx_bytes_per_sec,
    CAST(sum(packet_size_bytes) AS BIGINT) AS total_bytes_per_sec
  FROM packets GROUP BY ALL)"""


_UNION = f"""{_TIMED},
merged AS (
  SELECT CAST(flow_id AS BIGINT) AS flow_id, severity, attack_type, src_ip, dst_ip,
    flow_bytes_s AS bytes_per_sec, pqc_enabled, event_ms AS timestamp_ms, FALSE AS is_ml
  FROM timed WHERE attack_type <> 'Normal'
  UNION ALL
  SELECT CAST(flow_id AS BIGINT), {_LABEL_SEVERITY}, attack_type, src_ip, dst_ip,
    flow_bytes_s, pqc_enabled, event_ms, TRUE
  FROM timed)"""


def _running(part: str) -> str:
    return f"""{_TIMED},
run AS (SELECT src_ip, flow_id, event_us, event_ms, count(*) OVER w AS flow_count,
    avg(floor(flow_bytes_s)) OVER w AS avg_bytes_s, avg(flow_packets_s) OVER w AS avg_packets_s
  FROM timed
  WINDOW w AS ({part} ORDER BY event_us, flow_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _horizon(length: int, slide: int) -> str:
    return f"""WITH {_TIMED},
starts AS (SELECT (event_ms // {slide * 1000} - j) * {slide * 1000} AS s, flow_bytes_s, flow_packets_s
  FROM timed, range({length // slide}) t(j))
SELECT s AS window_start, s + {length * 1000} AS window_end, count(*) AS flow_count,
  avg(floor(flow_bytes_s)) AS avg_bytes_s, avg(flow_packets_s) AS avg_packets_s
FROM starts GROUP BY s"""


def _one_decimal(x: str) -> str:
    return f"printf('%.1f', CASE WHEN abs({x}) % 1 = 0.25 THEN {x} + 0.01 ELSE {x} END)"


_CONFUSION = f"""{_FLOWS},
c AS (SELECT attack_type AS prediction,
    CASE WHEN flow_id % 7 = 0 THEN 'BURST' ELSE attack_type END AS label FROM flows),
cc AS (SELECT label, prediction, count(*) AS "count" FROM c GROUP BY ALL),
k AS (SELECT DISTINCT label AS c FROM cc UNION SELECT DISTINCT prediction FROM cc),
per AS (SELECT k.c,
    coalesce((SELECT sum("count") FROM cc WHERE label = k.c), 0) AS actual,
    coalesce((SELECT sum("count") FROM cc WHERE prediction = k.c), 0) AS predicted,
    coalesce((SELECT sum("count") FROM cc WHERE label = k.c AND prediction = k.c), 0) AS hits
  FROM k),
pr AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS p,
    CASE WHEN actual = 0 THEN 0 ELSE hits / actual END AS r FROM per),
m AS (SELECT sum(hits) / sum(actual) AS accuracy, sum(p * actual) / sum(actual) AS "precision",
    sum(r * actual) / sum(actual) AS recall,
    sum(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END * actual) / sum(actual) AS f1 FROM pr)"""

_SERIES = """
sv AS (SELECT event_type AS series_id, (epoch_us(ts) - 1704067200000000) // 7200000000 AS time_bucket,
    user_id % 2 = 0 AS even, CAST(floor(1000 + value) AS BIGINT) AS v FROM events),
series AS (SELECT series_id, time_bucket,
    CAST(coalesce(sum(v) FILTER (even), 0) AS BIGINT) AS tx_bytes_per_sec,
    CAST(coalesce(sum(v) FILTER (NOT even), 0) AS BIGINT) AS rx_bytes_per_sec,
    CAST(sum(v) AS BIGINT) AS total_bytes_per_sec
  FROM sv GROUP BY ALL),
placed AS (SELECT series_id, time_bucket, tx_bytes_per_sec / 1000.0::DOUBLE AS tx,
    rx_bytes_per_sec / 1000.0::DOUBLE AS rx, total_bytes_per_sec / 1000.0::DOUBLE AS total,
    row_number() OVER (PARTITION BY series_id ORDER BY time_bucket) - 1 AS idx,
    count(*) OVER (PARTITION BY series_id) AS n
  FROM series),
fr AS (SELECT *, idx < CAST(floor(n * 0.8::DOUBLE) AS BIGINT) AS is_train,
    lag(total) OVER (PARTITION BY series_id ORDER BY idx) AS total_1,
    lag(tx) OVER (PARTITION BY series_id ORDER BY idx) AS tx_1,
    lag(rx) OVER (PARTITION BY series_id ORDER BY idx) AS rx_1
  FROM placed)"""

_AR1 = """
ar AS (SELECT series_id, count(*) AS n, regr_slope(total, total_1) AS slope,
    regr_intercept(total, total_1) AS intercept
  FROM fr WHERE is_train AND total_1 IS NOT NULL GROUP BY series_id)"""

_CENTRED = """
mu AS (SELECT series_id, avg(total) AS m, var_pop(total) AS v FROM fr WHERE is_train GROUP BY series_id),
cen AS (SELECT fr.*, total - m AS r, total_1 - m AS r_1 FROM fr JOIN mu USING (series_id)),
arch AS (SELECT series_id, count(*) AS n, regr_slope(r * r, r_1 * r_1) AS slope,
    regr_intercept(r * r, r_1 * r_1) AS intercept
  FROM cen WHERE is_train AND r_1 IS NOT NULL GROUP BY series_id)"""

_VAR1 = """
vr AS (SELECT * FROM fr WHERE is_train AND tx_1 IS NOT NULL),
mo AS (SELECT series_id, count(*) AS t, avg(tx) AS mx, avg(rx) AS my, avg(tx_1) AS m1, avg(rx_1) AS m2,
    var_pop(tx_1) AS s11, var_pop(rx_1) AS s22, covar_pop(tx_1, rx_1) AS s12,
    covar_pop(tx, tx_1) AS c11, covar_pop(tx, rx_1) AS c12,
    covar_pop(rx, tx_1) AS c21, covar_pop(rx, rx_1) AS c22 FROM vr GROUP BY series_id),
co AS (SELECT *, (c11 * s22 - c12 * s12) / (s11 * s22 - s12 * s12) AS axx, (c12 * s11 - c11 * s12) / (s11 * s22 - s12 * s12) AS axy,
    (c21 * s22 - c22 * s12) / (s11 * s22 - s12 * s12) AS ayx, (c22 * s11 - c21 * s12) / (s11 * s22 - s12 * s12) AS ayy FROM mo),
re AS (SELECT series_id, tx - (mx - axx * m1 - axy * m2) - axx * tx_1 - axy * rx_1 AS ex,
    rx - (my - ayx * m1 - ayy * m2) - ayx * tx_1 - ayy * rx_1 AS ey FROM vr JOIN co USING (series_id)),
ll AS (SELECT series_id, count(*) AS t,
    ln(avg(ex * ex) * avg(ey * ey) - avg(ex * ey) * avg(ex * ey)) AS ld FROM re GROUP BY series_id)"""

# variance with given coefficients: omega 0.1 * variance, alpha 0.1, beta 0.8
_VARIANCE_RUN = f"""WITH RECURSIVE {_SERIES},
{_CENTRED},
bc AS (SELECT series_id, sum(pow(0.94::DOUBLE, idx) * r * r) / sum(pow(0.94::DOUBLE, idx)) AS b
  FROM cen WHERE is_train AND idx < 75 GROUP BY series_id),
c AS (SELECT cen.series_id, idx, r, 0.1::DOUBLE * v AS omega, b FROM cen JOIN mu USING (series_id) JOIN bc USING (series_id)),
h AS (
  SELECT series_id, idx, r, omega + 0.1::DOUBLE * b + 0.8::DOUBLE * b AS variance FROM c WHERE idx = 0
  UNION ALL
  SELECT c.series_id, c.idx, c.r, c.omega + 0.1::DOUBLE * h.r * h.r + 0.8::DOUBLE * h.variance
  FROM h JOIN c ON c.series_id = h.series_id AND c.idx = h.idx + 1)
SELECT series_id, idx, round(r, 7) AS r, round(variance, 7) AS variance FROM h"""


def _permissive(column: str, value: str, broken: str) -> str:
    return f"CASE WHEN flow_id % 10 = 0 THEN {broken} ELSE {value} END AS {column}"


def _forest(source: str, values: str, label: str) -> str:
    """A walk over the nodes of the stored forest: ``values`` are the features of ``source`` in their order."""
    nodes = ", ".join(
        f"({t}, {n}, {f}, {'NULL' if cut is None else cut}::DOUBLE, {a}, {b}, {[x / sum(c) for x in c]}::DOUBLE[])"
        for t, n, f, cut, a, b, c in FOREST_NODES
    )
    return f"""
nodes AS (SELECT * FROM (VALUES {nodes}) t(tree, node, feature, cut, lower, upper, votes)),
x AS (SELECT flow_id, {label} AS label, [{values}] AS v FROM {source}),
walk AS (
  SELECT flow_id, tree, 0 AS node FROM x, (SELECT DISTINCT tree FROM nodes)
  UNION ALL
  SELECT x.flow_id, walk.tree, CASE WHEN x.v[n.feature + 1] <= n.cut THEN n.lower ELSE n.upper END
  FROM walk JOIN nodes n ON walk.tree = n.tree AND walk.node = n.node AND n.feature >= 0 JOIN x ON x.flow_id = walk.flow_id),
summed AS (SELECT flow_id, sum(votes[1]) AS v0, sum(votes[2]) AS v1, sum(votes[3]) AS v2, sum(votes[4]) AS v3
  FROM walk JOIN nodes n ON walk.tree = n.tree AND walk.node = n.node AND n.feature < 0 GROUP BY flow_id),
told AS (SELECT *, list_position([v0, v1, v2, v3], greatest(v0, v1, v2, v3)) AS best FROM summed),
forest AS (SELECT flow_id, label, v0, v1, v2, v3, CAST(best - 1 AS DOUBLE) AS prediction,
    {FOREST_LABELS}[best] AS predicted_attack
  FROM told JOIN x USING (flow_id))"""


_SWAPPED = "CASE WHEN flow_id % 35 = 0 THEN 'BURST' ELSE label END"
_FLOW_FOREST = f"""WITH RECURSIVE features AS ({_feature_sql("flow_id")}),
{_forest("features", ", ".join(f'"{n}"' for n in FEATURES), _SWAPPED)}"""

_SAFE_RATE = "CASE WHEN flow_id % 10 IN (0, 3) THEN 0.0::DOUBLE ELSE flow_bytes_s END"
_ZERO = "0.0::DOUBLE"

ORACLES: dict[str, str] = {
    "packet_gaps": f"""WITH {_PACKETS}
SELECT flow_id, timestamp_s, packet_size_bytes,
  timestamp_s - lag(timestamp_s) OVER (PARTITION BY flow_id ORDER BY timestamp_s) AS iat FROM packets""",
    "flow_feature_table": _feature_sql("flow_id"),
    "flow_features_by_run": _feature_sql("run_id, flow_id"),
    "flow_features_sent": f"""WITH {_PACKETS},
f AS (SELECT flow_id, greatest(max(timestamp_s) - min(timestamp_s), 0.001::DOUBLE) AS d, count(*) AS n,
    sum(packet_size_bytes) AS b FROM packets WHERE direction = 'tx' GROUP BY flow_id)
SELECT flow_id, n AS "Total_Fwd_Packets", round(b / d, 3) AS "Flow_Bytes_s", round(n / d, 3) AS "Flow_Packets_s" FROM f""",
    "flow_alerts": f"""WITH {_PACKETS},
g AS (SELECT *, timestamp_s - lag(timestamp_s) OVER (PARTITION BY flow_id ORDER BY timestamp_s) AS iat FROM packets),
f AS (SELECT flow_id, min(attack_type) AS label, greatest(max(timestamp_s) - min(timestamp_s), 0.001::DOUBLE) AS d,
    count(*) AS n, sum(packet_size_bytes) AS b, coalesce(avg(iat), 0) AS flow_iat_mean,
    coalesce(stddev_samp(iat), 0) AS flow_iat_std, avg(packet_size_bytes) AS fwd_pkt_len_mean FROM g GROUP BY flow_id),
r AS (SELECT *, b / d AS flow_bytes_s, n / d AS flow_packets_s FROM f)
SELECT flow_id, label, {_RULES} AS rule_type, {_SEVERITY} AS severity,
  round(flow_bytes_s, 3) AS "Flow_Bytes_s", round(flow_packets_s, 3) AS "Flow_Packets_s" FROM r""",
    "counter_metrics": """WITH c AS (
  SELECT l_orderkey, l_linenumber, CAST(l_quantity * 3 AS BIGINT) AS tp, CAST(l_quantity * 2 - 2 AS BIGINT) AS rp,
    l_extendedprice * 3.0::DOUBLE AS tb, l_extendedprice * 2.0::DOUBLE AS rb,
    CASE WHEN l_tax * 100.0::DOUBLE <= 0 THEN 0.001::DOUBLE ELSE l_tax * 100.0::DOUBLE END AS d, l_discount AS delay FROM lineitem),
m AS (SELECT *, CASE WHEN rp > 1 THEN d / (rp - 1) * 1000.0::DOUBLE ELSE 0 END AS im,
    CASE WHEN rp > 1 THEN delay / rp * 1000.0::DOUBLE * 2.0::DOUBLE ELSE 0 END AS ix,
    CASE WHEN tp > 0 THEN tb / tp ELSE 0 END AS lm FROM c)
SELECT l_orderkey, l_linenumber, d AS flow_duration, rb / d AS flow_bytes_s, (rp + tp) / d AS flow_packets_s,
  im AS flow_iat_mean, im * 0.3::DOUBLE AS flow_iat_std, ix AS flow_iat_max, im * 0.5::DOUBLE AS flow_iat_min,
  lm AS fwd_pkt_len_mean, lm * 0.1::DOUBLE AS fwd_pkt_len_std, lm * 1.2::DOUBLE AS fwd_pkt_len_max,
  lm * 0.8::DOUBLE AS fwd_pkt_len_min FROM m""",
    "class_codes": """SELECT event_id, CASE event_id % 6 WHEN 1 THEN 'FLOOD' WHEN 2 THEN 'STEALTH'
  WHEN 3 THEN 'BURST' ELSE 'Normal' END AS label FROM events""",
    "attached_metadata": f"""WITH {_PACKETS}, {_FLOWS},
meta AS (SELECT DISTINCT port AS dst_port, attack_type, kem_handshake_ms AS meta_kem_ms, sig_sign_ms AS meta_sign_ms
  FROM packets WHERE flow_id % 10 <> 9)
SELECT f.dst_port, flow_id, flow_bytes_s, coalesce(meta.attack_type, 'Normal') AS attack_type, meta_kem_ms, meta_sign_ms
FROM flows f LEFT JOIN meta ON f.dst_port = meta.dst_port""",
    "rule_classify": f"WITH {_FLOWS} SELECT flow_id, flow_bytes_s, attack_type, severity FROM flows",
    "rule_alerts": f"WITH {_FLOWS} SELECT {_ALERT_COLUMNS} FROM flows WHERE attack_type <> 'Normal'",
    "label_severity": f"""WITH {_FLOWS}
SELECT flow_id, flow_packets_s, attack_type, {_LABEL_SEVERITY} AS severity FROM flows""",
    "ml_alerts": f"""WITH {_TIMED}
SELECT flow_id AS "flowId", src_ip AS "srcIp", dst_ip AS "dstIp", flow_bytes_s AS "flowBytesPerSec",
  flow_packets_s AS "flowPacketsPerSec", attack_type AS "attackType", {_LABEL_SEVERITY} AS severity,
  pqc_enabled AS "pqcEnabled", round(kem_handshake_ms, 6) AS "kemHandshakeMs", round(sig_sign_ms, 6) AS "sigSignMs",
  event_ms AS "timestamp", 'spark-ml' AS source FROM timed""",
    "ml_attack_alerts": f"""WITH {_TIMED}
SELECT flow_id AS "flowId", attack_type AS "attackType", {_LABEL_SEVERITY} AS severity, event_ms AS "timestamp"
FROM timed WHERE attack_type <> 'Normal'""",
    "alerts_union": f"WITH {_UNION} SELECT * FROM merged",
    "alert_json": f"""WITH {_TIMED}, a AS (SELECT {_ALERT_COLUMNS}, event_ms FROM timed WHERE attack_type <> 'Normal')
SELECT "flowId", "attackType", event_ms AS "timestamp", message, "pqcEnabled" FROM a""",
    "severity_filtered": f"""WITH {_UNION}
SELECT flow_id, attack_type, severity, timestamp_ms, is_ml FROM merged WHERE severity = 'HIGH'""",
    "alert_counter": f"""WITH {_UNION} SELECT severity, count(*) AS "count" FROM merged GROUP BY severity""",
    "latest_alerts": f"""WITH {_UNION} SELECT flow_id, attack_type, severity, timestamp_ms, is_ml FROM merged
ORDER BY timestamp_ms DESC, flow_id DESC, is_ml DESC LIMIT 50""",
    "alert_history": f"""WITH {_TIMED} SELECT flow_id AS "flowId", severity, event_ms AS "timestamp" FROM timed
WHERE attack_type <> 'Normal' ORDER BY event_ms DESC, flow_id DESC LIMIT 200""",
    "topic_rows": f"""WITH {_TIMED} SELECT CAST(flow_id AS VARCHAR) AS key, CAST(1704067200000 AS BIGINT) AS exported_at,
  'ns3-simulator' AS source, src_ip, flow_bytes_s FROM timed""",
    "flow_stats_10s": _WINDOW_STATS,
    "flow_stats_total": f"WITH {_FLOWS} {_stats_sql('flows')}",
    "flow_stats_merge": f"WITH {_FLOWS} {_stats_sql('flows')}",
    "attack_histogram": f"""WITH {_FLOWS}, s AS ({_stats_sql('flows', 'GROUP BY dst_port', 'dst_port,')})
SELECT dst_port, n_flood, n_stealth, n_burst, "totalFlows" FROM s""",
    "class_distribution": f"""WITH {_FLOWS} SELECT attack_type, count(*) AS "count" FROM flows GROUP BY attack_type""",
    "run_totals": f"""WITH {_PACKETS} SELECT run_id, count(*) AS "count" FROM packets GROUP BY run_id""",
    "running_rates": f"""WITH {_running('PARTITION BY src_ip')}
SELECT src_ip, flow_id, flow_count, avg_bytes_s, avg_packets_s FROM run""",
    "running_rates_overall": f"WITH {_running('')} SELECT flow_id, flow_count, avg_bytes_s, avg_packets_s FROM run",
    "chart_points": f"""WITH {_running('')} SELECT flow_id, event_ms, flow_count, avg_bytes_s FROM run
ORDER BY event_ms DESC, flow_id DESC LIMIT 60""",
    "rate_values": f"""WITH {_TIMED} SELECT flow_id, CASE WHEN flow_id % 3 <> 0 AND flow_bytes_s <> 0 THEN flow_bytes_s
  WHEN flow_id % 2 = 0 THEN flow_packets_s ELSE 0 END AS bytes_value FROM timed""",
    "horizon_30s": _horizon(30, 10),
    "horizon_60s": _horizon(60, 10),
    "horizon_300s": _horizon(300, 60),
    "display_numbers": f"""WITH {_FLOWS} SELECT flow_id, flow_bytes_s,
  CASE WHEN flow_bytes_s >= 1e6 THEN {_one_decimal('(flow_bytes_s / 1e6::DOUBLE)')} || 'M'
       WHEN flow_bytes_s >= 1e3 THEN {_one_decimal('(flow_bytes_s / 1e3::DOUBLE)')} || 'K'
       ELSE CAST(CAST(floor(flow_bytes_s + 0.5::DOUBLE) AS BIGINT) AS VARCHAR) END AS bytes_text,
  CASE WHEN pqc_enabled THEN {_one_decimal('(flow_iat_mean * 100.0::DOUBLE)')} || '%' ELSE '—' END AS percent_text
FROM flows""",
    "bandwidth": f"WITH {_PACKETS}, {_bandwidth()} SELECT * FROM bw",
    "bandwidth_by_run": f"WITH {_PACKETS}, {_bandwidth('run_id')} SELECT * FROM bw",
    "bandwidth_megabytes": f"""WITH {_PACKETS}, {_bandwidth()}
SELECT time_bucket, tx_bytes_per_sec / 1e6::DOUBLE AS tx, rx_bytes_per_sec / 1e6::DOUBLE AS rx,
  total_bytes_per_sec / 1e6::DOUBLE AS total FROM bw""",
    "bandwidth_split": f"""WITH {_PACKETS}, {_bandwidth('run_id')},
p AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY time_bucket) - 1 AS idx,
    CAST(floor(count(*) OVER (PARTITION BY run_id) * 0.8::DOUBLE) AS BIGINT) AS n_train FROM bw)
SELECT run_id, time_bucket, total_bytes_per_sec, idx, n_train, idx < n_train AS is_train FROM p""",
    "filled_series": f"""WITH {_SERIES},
ends AS (SELECT series_id, min(time_bucket) AS lo, max(time_bucket) AS hi FROM series GROUP BY series_id),
b AS (SELECT series_id, unnest(range(lo, hi + 1)) AS time_bucket FROM ends)
SELECT b.series_id, b.time_bucket, coalesce(total_bytes_per_sec, 0) AS total_bytes_per_sec
FROM b LEFT JOIN series s ON s.series_id = b.series_id AND s.time_bucket = b.time_bucket""",
    "decode_strict": f"""WITH {_DECODED}
SELECT flow_id, src_ip, dst_port, flow_bytes_s, flow_packets_s, pqc_enabled, kem_handshake_ms,
  CAST(0 AS INTEGER) AS sig_bytes, '' AS "timestamp" FROM timed""",
    "decode_permissive": f"""WITH {_TIMED}
SELECT {_permissive('flow_id', 'flow_id', '0')}, {_permissive('src_ip', 'src_ip', 'NULL')},
  {_permissive('dst_port', 'dst_port', '0')}, {_SAFE_RATE} AS flow_bytes_s,
  {_permissive('flow_packets_s', 'flow_packets_s', _ZERO)}, {_permissive('pqc_enabled', 'pqc_enabled', 'NULL')},
  {_permissive('kem_handshake_ms', 'kem_handshake_ms', _ZERO)}, CAST(0 AS INTEGER) AS sig_bytes,
  CAST(NULL AS VARCHAR) AS "timestamp" FROM timed""",
    "training_names": f"""WITH {_TIMED}
SELECT {_permissive('flow_id', 'flow_id', '0')}, {_SAFE_RATE} AS "Flow_Bytes_s",
  {_permissive('"Flow_Packets_s"', 'flow_packets_s', _ZERO)}, {_permissive('"Flow_IAT_Mean"', 'flow_iat_mean', _ZERO)},
  {_permissive('"Flow_IAT_Std"', 'flow_iat_std', _ZERO)}, {_ZERO} AS "Flow_IAT_Max", {_ZERO} AS "Flow_IAT_Min",
  {_permissive('"Fwd_Pkt_Len_Mean"', 'fwd_pkt_len_mean', _ZERO)}, {_ZERO} AS "Fwd_Pkt_Len_Std",
  {_ZERO} AS "Fwd_Pkt_Len_Max", {_ZERO} AS "Fwd_Pkt_Len_Min", {_ZERO} AS "Flow_Duration",
  CAST(0 AS INTEGER) AS "Total_Fwd_Packets", {_permissive('"KEM_Handshake_ms"', 'kem_handshake_ms', _ZERO)},
  {_permissive('"SIG_Sign_ms"', 'sig_sign_ms', _ZERO)}, {_ZERO} AS "SIG_Verify_ms" FROM timed""",
    "detected_alerts": f"WITH {_DECODED} SELECT {_ALERT_COLUMNS} FROM timed WHERE attack_type <> 'Normal'",
    "csv_bandwidth": f"WITH {_PACKETS}, {_bandwidth()} SELECT * FROM bw",
    "parquet_copy": f"""WITH {_PACKETS} SELECT attack_type, pqc_enabled, count(*) AS packets,
  CAST(sum(packet_size_bytes) AS BIGINT) AS bytes FROM packets GROUP BY ALL""",
    "training_from_csv": f"""WITH {_PACKETS} SELECT flow_id, count(*) AS "Total_Fwd_Packets",
  max(packet_size_bytes) AS "Fwd_Pkt_Len_Max", min(attack_type) AS label FROM packets GROUP BY flow_id""",
    "run_files": f"""WITH {_PACKETS} SELECT run_id, count(*) AS packets,
  CAST(sum(packet_size_bytes) AS BIGINT) AS bytes FROM packets GROUP BY run_id""",
    "confusion": f"""WITH {_CONFUSION} SELECT label, prediction, "count" FROM cc""",
    "classification_metrics": f"""WITH {_CONFUSION} SELECT round(accuracy, 9) AS accuracy,
  round("precision", 9) AS "precision", round(recall, 9) AS recall, round(f1, 9) AS f1 FROM m""",
    "metric_texts": f"""WITH {_CONFUSION} SELECT printf('%.1f%%', accuracy * 100) AS accuracy,
  printf('%.1f%%', "precision" * 100) AS "precision", printf('%.1f%%', recall * 100) AS recall,
  printf('%.1f%%', f1 * 100) AS f1 FROM m""",
    "stream_flow_stats": _WINDOW_STATS,
    "forest_predict": f"""{_FLOW_FOREST}
SELECT flow_id, label, prediction, predicted_attack, round(v0, 9) AS votes_normal, round(v1, 9) AS votes_flood,
  round(v2, 9) AS votes_burst, round(v3, 9) AS votes_stealth FROM forest""",
    "forest_confusion": f"""{_FLOW_FOREST} SELECT label, predicted_attack, count(*) AS "count" FROM forest GROUP BY ALL""",
    "forest_reloaded": "SELECT count(DISTINCT user_id) AS n_flows, count(DISTINCT user_id) AS n_equal FROM events",
    "stream_forest_alerts": f"""WITH RECURSIVE {_EVENTS},
m AS (SELECT CAST(event_id AS INTEGER) AS flow_id, event_id % 10 = 0 AS broken, event_id % 10 = 3 AS bare,
    value * value * 100.0::DOUBLE AS rate, k * 50.0::DOUBLE AS pace, 1.0::DOUBLE + user_id % 7 AS gap,
    event_id % 5 * 0.5::DOUBLE AS spread, 40.0::DOUBLE + k * 10.0::DOUBLE AS size, k FROM e),
{_forest("m", "CASE WHEN broken OR bare THEN 0 ELSE rate END, CASE WHEN broken THEN 0 ELSE pace END, 0, 0, 0, 0, CASE WHEN broken THEN 0 ELSE size END, 0, 0, 0, 0, 0, 0, 0, 0", "broken")}
SELECT CASE WHEN broken THEN 0 ELSE flow_id END AS "flowId", CASE WHEN broken OR bare THEN 0.0::DOUBLE ELSE rate END AS "flowBytesPerSec",
  predicted_attack AS "attackType", CASE predicted_attack WHEN 'FLOOD' THEN 'CRITICAL' WHEN 'BURST' THEN 'HIGH'
  WHEN 'STEALTH' THEN 'MEDIUM' ELSE 'LOW' END AS severity, 'spark-ml' AS source FROM forest JOIN m USING (flow_id)""",
    "stream_arrival_stats": f"""WITH {_TIMED}, w AS (SELECT * REPLACE (floor(flow_bytes_s) AS flow_bytes_s) FROM timed)
{_stats_sql('w')}""",
    "stream_running_rates": f"""WITH {_running('PARTITION BY src_ip')}
SELECT src_ip, flow_id, flow_count, avg_bytes_s, avg_packets_s FROM run""",
    "stream_alert_history": f"""WITH {_TIMED} SELECT flow_id AS "flowId", severity, event_ms AS "timestamp" FROM timed
WHERE attack_type <> 'Normal' ORDER BY event_ms DESC, flow_id DESC LIMIT 200""",
    "stream_alerts_union": f"WITH {_UNION} SELECT * FROM merged",
    "stream_messages": f"""WITH {_TIMED}, a AS (SELECT {_ALERT_COLUMNS}, event_ms FROM timed WHERE attack_type <> 'Normal')
SELECT "flowId", "attackType", event_ms AS "timestamp", message, "pqcEnabled" FROM a""",
    "stream_alerts": f"WITH {_DECODED} SELECT {_ALERT_COLUMNS} FROM timed WHERE attack_type <> 'Normal'",
    "stream_rolled_lines": f"""WITH {_DECODED}, a AS (SELECT {_ALERT_COLUMNS} FROM timed WHERE attack_type <> 'Normal')
SELECT "flowId", "attackType", severity, "flowBytesPerSec", "pqcEnabled", TRUE AS within FROM a""",
    "stream_alert_lines": f"""WITH {_DECODED}, a AS (SELECT {_ALERT_COLUMNS} FROM timed WHERE attack_type <> 'Normal')
SELECT "flowId", "attackType", severity, "flowBytesPerSec", "pqcEnabled" FROM a""",
    "naive_error": f"""WITH {_SERIES} SELECT series_id, round(sqrt(avg(pow(total - total_1, 2))), 8) AS rmse,
  round(avg(abs(total - total_1)), 8) AS mae FROM fr WHERE NOT is_train GROUP BY series_id""",
    "ar1_ols": f"""WITH {_SERIES}, {_AR1} SELECT series_id, n, round(slope, 8) AS slope,
  round(intercept, 8) AS intercept FROM ar""",
    "arch1_ols": f"""WITH {_SERIES}, {_CENTRED} SELECT series_id, n, round(slope, 8) AS slope,
  round(intercept, 8) AS intercept FROM arch""",
    "var1_ols": f"""WITH {_SERIES}, {_VAR1} SELECT series_id, mo.t AS nobs,
  round(mx - axx * m1 - axy * m2, 7) AS const_tx, round(my - ayx * m1 - ayy * m2, 7) AS const_rx,
  round(axx, 7) AS tx_from_tx, round(ayx, 7) AS rx_from_tx, round(axy, 7) AS tx_from_rx, round(ayy, 7) AS rx_from_rx,
  round(-mo.t * ln(2 * pi()) - 0.5 * mo.t * (ld + 2), 5) AS llf, round(ld + 12.0::DOUBLE / mo.t, 5) AS aic,
  round(ld + 6 * ln(mo.t) / mo.t, 5) AS bic
FROM co mo JOIN ll USING (series_id)""",
    "forecast_anomalies": f"""WITH {_SERIES}, {_AR1},
p AS (SELECT fr.*, intercept + slope * total_1 AS yhat FROM fr JOIN ar USING (series_id)),
s AS (SELECT series_id, sqrt(avg(pow(total - yhat, 2))) AS sigma FROM p WHERE is_train GROUP BY series_id)
SELECT series_id, time_bucket, total, round(yhat, 7) AS yhat, round(sigma, 7) AS sigma,
  coalesce(total > yhat + 2 * sigma, FALSE) AS is_anomaly FROM p JOIN s USING (series_id)""",
    "variance_anomalies": f"""WITH {_SERIES}, {_CENTRED},
p AS (SELECT cen.*, intercept + slope * r_1 * r_1 AS variance FROM cen JOIN arch USING (series_id))
SELECT series_id, time_bucket, round(r, 7) AS r, round(variance, 7) AS variance,
  coalesce(r * r > 4 * variance, FALSE) AS is_shock FROM p""",
    "variance_run": _VARIANCE_RUN,
    "label_index": f"""WITH {_PACKETS},
one AS (SELECT flow_id, CASE WHEN flow_id % 35 = 0 THEN 'BURST' ELSE min(attack_type) END AS label FROM packets GROUP BY flow_id)
SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, label) - 1 AS INTEGER) AS label_index, label FROM one GROUP BY label""",
    "arma_forecast": f"""WITH RECURSIVE {_SERIES},
given AS (SELECT series_id, avg(total) AS m, max(idx) AS top FROM fr WHERE is_train GROUP BY series_id),
w AS (SELECT fr.series_id, idx, total - m AS w, coalesce(total_1 - m, 0) AS w_1 FROM fr JOIN given USING (series_id) WHERE is_train),
e AS (SELECT series_id, idx, w - 0.5::DOUBLE * w_1 AS e FROM w WHERE idx = 0
  UNION ALL
  SELECT w.series_id, w.idx, w.w - 0.5::DOUBLE * w.w_1 + 0.9::DOUBLE * e.e FROM e JOIN w ON w.series_id = e.series_id AND w.idx = e.idx + 1),
done AS (SELECT series_id, sum(e * e) AS squares, arg_max(e, idx) AS last_e FROM e GROUP BY series_id),
ahead AS (SELECT series_id, 0.5::DOUBLE * arg_max(w, idx) - 0.9::DOUBLE * any_value(last_e) AS a FROM w JOIN done USING (series_id) GROUP BY series_id)
SELECT fr.series_id, 'ARMA(1,1)' AS model, fr.idx - top AS step, round(m + a * pow(0.5::DOUBLE, fr.idx - top - 1), 6) AS yhat,
  round(squares, 4) AS squares, round(last_e, 6) AS last_e
FROM fr JOIN given USING (series_id) JOIN done USING (series_id) JOIN ahead USING (series_id) WHERE NOT is_train""",
    "given_rank": f"""WITH {_SERIES},
s AS (SELECT series_id, round(avg(tx), 3) AS tx, round(avg(rx), 3) AS rx FROM fr GROUP BY series_id),
t AS (SELECT series_id, 'ARMA(1,1)' AS model, tx AS rmse, rx AS aic FROM s UNION ALL SELECT series_id, 'ARIMA(1,1,1)', rx, tx FROM s
  UNION ALL SELECT series_id, 'SARIMA', rx, tx FROM s UNION ALL SELECT series_id, 'VAR', tx, tx FROM s UNION ALL SELECT series_id, 'GARCH(1,1)', NULL, rx FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY rmse NULLS LAST, model) AS a,
  row_number() OVER (PARTITION BY series_id ORDER BY CASE WHEN model <> 'VAR' THEN aic END NULLS LAST, model) AS b FROM t)
SELECT series_id, model, rmse, aic, CASE WHEN rmse IS NOT NULL THEN CAST(a AS INTEGER) END AS rmse_rank,
  CASE WHEN model <> 'VAR' AND aic IS NOT NULL THEN CAST(b AS INTEGER) END AS aic_rank, coalesce(rmse IS NOT NULL AND a = 1, false) AS winner FROM r""",
    "naive_plot_rows": f"""WITH {_SERIES},
g AS (SELECT series_id, max(idx) AS top, arg_max(total, idx) AS y FROM fr WHERE is_train GROUP BY series_id)
SELECT fr.series_id, idx - top AS step, 'Actual' AS model, total AS value FROM fr JOIN g USING (series_id) WHERE NOT is_train
UNION ALL SELECT fr.series_id, idx - top, 'naive', y FROM fr JOIN g USING (series_id) WHERE NOT is_train""",
}
