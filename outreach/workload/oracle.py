"""Each registered query in SQL, written from the meaning of the operator.

VIEWS states the domain tables and the stages of the decision as common table expressions;
`_with` puts the ones a query needs in front of it. Nothing here is used by the operators.
"""

from __future__ import annotations

import re

SEED = 33  # ISO week 31 plus weekday 2 of 2001-08-01
RUN_DATE = "DATE '2001-08-01'"

_UNRESOLVED = r"""(contains(lower({0}), 'value_not_found') OR lower({0}) = 'none'
  OR regexp_matches(lower({0}), '\b(nan|null)\b'))"""
_BAND = "(test_keys BETWEEN 17 AND 50 OR test_keys BETWEEN 83 AND 99)"
_KEYED = "(email_address IS NOT NULL AND tpid IS NOT NULL AND eapid IS NOT NULL)"
_CONTACT = "SELECT DISTINCT lower(email_address) AS email_address, tpid, eapid FROM"
_CKEY = "campaign_id, test_keys, segment_set"
_CONTENT = f"city, mktsegment, {_CKEY}"

VIEWS: dict[str, str] = {}

VIEWS["nations"] = """
SELECT n_nationkey, n_name, n_regionkey AS tpid, n_nationkey % 2 AS eapid,
       concat('en_', lower(substr(r_name, 1, 2))) AS locale
FROM nation JOIN region ON n_regionkey = r_regionkey"""

VIEWS["traveler"] = """
SELECT c_custkey AS user_id,
       concat('user', CASE WHEN c_custkey % 40 = 0 THEN c_custkey + 1 ELSE c_custkey END,
              '@example.com') AS email_address,
       tpid, eapid, locale, CAST(c_custkey % 100 AS INT) AS test_keys,
       CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS mer_status,
       CASE WHEN c_custkey % 97 <> 0 THEN c_custkey END AS paid,
       CASE WHEN c_custkey % 11 <> 0 THEN n_name END AS city,
       c_mktsegment AS mktsegment, c_acctbal AS acctbal, c_name AS first_name
FROM customer JOIN nations ON c_nationkey = n_nationkey"""

VIEWS["membership"] = """
SELECT user_id, 1 AS ord, CASE mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2
         WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 WHEN 'MACHINERY' THEN 5 END AS seg
FROM traveler
UNION ALL SELECT user_id, 2, 6 FROM traveler WHERE acctbal BETWEEN 0 AND 6000
UNION ALL SELECT user_id, 3, 7 FROM traveler WHERE acctbal > 5000"""

VIEWS["segment_sets"] = """
SELECT user_id, string_agg(CAST(seg AS VARCHAR), '#' ORDER BY ord) AS segment_set
FROM membership GROUP BY user_id"""

VIEWS["traveler_segment"] = """
SELECT t.email_address, t.test_keys, t.tpid, t.eapid, t.locale, m.seg AS segment_type_id, s.segment_set
FROM traveler t JOIN membership m USING (user_id) JOIN segment_sets s USING (user_id)"""

VIEWS["segment"] = """
SELECT DISTINCT tpid, eapid, CAST(seg AS INT) AS segment_type_id,
       CASE WHEN (seg + tpid) % 6 = 3 THEN 1 ELSE 0 END AS segment_deleted_flag
FROM nations CROSS JOIN (SELECT unnest(range(1, 8)) AS seg)"""

VIEWS["campaign"] = """
SELECT campaign_id, tpid, eapid, locale, seg AS campaign_segment_type_id,
       campaign_id * 3 % 5 + 1 AS priority, deleted AS campaign_deleted_flag, launch_date,
       concat(CAST(launch_date AS VARCHAR), 'T00:00:00Z') AS launch_time_utc,
       concat('EML..PROG', seg, '.CODE', tpid, CASE WHEN seg = 5 THEN '' ELSE '.INTENT' END) AS program_type,
       campaign_id % 10 + 1 AS template_id, concat('AUD_', campaign_id) AS audience_name,
       campaign_id % 3 + 1 AS campaign_type_id, balance
FROM (SELECT CAST(s_suppkey AS INT) AS campaign_id, CAST(s_suppkey % 7 + 1 AS INT) AS seg,
             CASE WHEN s_suppkey % 3 = 2 THEN DATE '2001-08-02' ELSE DATE '2001-08-01' END AS launch_date,
             CASE WHEN s_acctbal < -300 THEN 1 ELSE 0 END AS deleted, s_acctbal AS balance,
             s_nationkey FROM supplier)
JOIN nations ON s_nationkey = n_nationkey"""

VIEWS["manual_launch"] = "SELECT campaign_id, locale, launch_date FROM campaign WHERE balance > 9000"

VIEWS["module"] = """
SELECT m.*, locale FROM (
  SELECT CAST(p_partkey AS INT) AS module_id, CAST(p_partkey % 5 AS INT) AS tpid,
         CAST(p_partkey // 5 % 2 AS INT) AS eapid, kind AS module_type_id,
         CASE kind % 4 WHEN 0 THEN 'subject' WHEN 1 THEN 'hero' WHEN 2 THEN 'banner' ELSE 'body' END AS placement_type,
         CASE CAST(replace(p_brand, 'Brand#', '') AS INT) % 5 WHEN 0 THEN 'email' WHEN 1 THEN 'app' WHEN 2 THEN 'web'
              WHEN 3 THEN 'push' ELSE 'sms' END AS channel,
         CASE p_partkey // 10 % 10 WHEN 9 THEN 'test published' WHEN 8 THEN 'draft' ELSE 'active published' END AS status,
         p_size % 5 + 1 AS version, p_type AS module_type, CAST(p_partkey // 10 % 2 AS INT) AS default_flag, p_size AS size
  FROM (SELECT *, CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
                   WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END AS kind FROM part)) m
JOIN (SELECT DISTINCT tpid, eapid, locale FROM nations) n ON m.tpid = n.tpid AND m.eapid = n.eapid"""

VIEWS["segment_module_map"] = """
SELECT module_type_id, seg AS segment_type_id, module_type_id * 10 + seg AS segment_module_map_id,
       seg * 10 + module_type_id AS module_priority_in_slot,
       CASE WHEN (module_type_id * 10 + seg) % 11 = 0 THEN 1 ELSE 0 END AS seg_mod_deleted_flag
FROM (SELECT DISTINCT module_type_id, size % 7 + 1 AS seg FROM module)"""

VIEWS["template"] = """
SELECT CAST(t AS INT) AS template_id, segment_module_map_id, module_type_id % 4 + 1 + step AS slot_position,
       CASE module_type_id % 4 WHEN 0 THEN 'subject' WHEN 1 THEN 'hero' WHEN 2 THEN 'banner' ELSE 'body' END AS placement_type,
       CASE t % 5 WHEN 0 THEN 'email' WHEN 1 THEN 'app' WHEN 2 THEN 'web' WHEN 3 THEN 'push' ELSE 'sms' END AS channel,
       CASE WHEN (t * 3 + segment_module_map_id) % 13 = 0 THEN 1 ELSE 0 END AS template_deleted_flag
FROM segment_module_map CROSS JOIN (SELECT unnest(range(1, 11)) AS t) CROSS JOIN (SELECT unnest([0, 1]) AS step)
WHERE step = 0 OR (module_type_id % 2 = 0 AND module_type_id % 4 + 1 < 4)"""

VIEWS["module_variable"] = """
SELECT module_id, tpid, eapid, locale, p AS var_position, module_id // 10 % 2 + 1 AS source_connection,
       CASE WHEN p = 1 THEN 'traveler.city|content.city' ELSE '' END AS var_source,
       CASE (module_id // 10 + p) % 8
         WHEN 0 THEN 'Hello' WHEN 1 THEN 'def|In %%traveler.city%%'
         WHEN 2 THEN 'def|A %%traveler.city%%|B %%content.best%%|C' WHEN 3 THEN ''
         WHEN 4 THEN 'Deal|Welcome %%traveler.mktsegment%%'
         WHEN 5 THEN 'def|%%content.best%% near %%traveler.city%%' WHEN 6 THEN NULL
         ELSE 'x|plain|%%traveler.city%% and %%traveler.city%%' END AS var_structure
FROM module CROSS JOIN (SELECT unnest([1, 2]) AS p) WHERE size <> 50"""

VIEWS["content"] = """
SELECT tpid, eapid, locale, n_name AS city, CASE WHEN n_nationkey % 5 <> 0 THEN best END AS best
FROM nations LEFT JOIN (SELECT s_nationkey, min(s_name) AS best FROM supplier GROUP BY 1)
  ON n_nationkey = s_nationkey"""

VIEWS["booking"] = """
SELECT upper(email_address) AS email_address, tpid, eapid, test_keys, o_orderdate AS create_date,
       o_orderdate + INTERVAL 10 DAY AS booking_start, o_orderdate + INTERVAL 17 DAY AS booking_end,
       o_orderdate + INTERVAL 30 DAY AS etl_update_date
FROM orders JOIN traveler ON o_custkey = user_id"""

VIEWS["notification"] = """
SELECT upper(email_address) AS email_address, tpid, eapid, test_keys, ts AS create_date
FROM events e JOIN traveler t ON e.user_id = t.user_id"""

VIEWS["run_log"] = """
SELECT event_id AS log_id, CAST(user_id AS INT) AS source_id, event_type AS source_name,
       CASE WHEN value > 20 THEN 1 ELSE 0 END AS is_complete, ts AS start_date,
       ts + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS end_date,
       concat('/data/run/', event_id) AS file_path, CAST(floor(value * 100) AS INT) AS row_counts
FROM events"""

VIEWS["booked_as_of"] = "SELECT max(o_orderdate) AS t FROM orders"
VIEWS["notified_as_of"] = "SELECT max(ts) AS t FROM events"

VIEWS["notified"] = f"""
{_CONTACT} notification, notified_as_of
WHERE ({_KEYED} AND create_date > t - INTERVAL 24 HOUR) OR ({_BAND} AND create_date > t + INTERVAL 7 DAY)"""
VIEWS["notified_strict"] = f"""
{_CONTACT} notification, notified_as_of
WHERE {_KEYED} AND (create_date > t - INTERVAL 24 HOUR OR ({_BAND} AND create_date > t - INTERVAL 7 DAY))"""
VIEWS["booked"] = f"""
{_CONTACT} booking, booked_as_of
WHERE {_KEYED} AND (create_date > t - INTERVAL 7 DAY OR booking_start BETWEEN t AND t - INTERVAL 24 HOUR
  OR booking_end BETWEEN t - INTERVAL 7 DAY AND t) AND {_BAND} AND etl_update_date > t - INTERVAL 1 DAY"""
VIEWS["booked_strict"] = VIEWS["booked"].replace(
    "booking_start BETWEEN t AND t - INTERVAL 24 HOUR", "booking_start BETWEEN t - INTERVAL 24 HOUR AND t"
)

VIEWS["seed"] = """
SELECT tpid, eapid, locale, concat('seed', s_suppkey, '@example.com') AS seed_email,
       CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS is_active,
       CASE WHEN s_acctbal < 8000 THEN 'Merch' ELSE 'Other' END AS category
FROM supplier JOIN nations ON s_nationkey = n_nationkey"""

VIEWS["schedule"] = """
SELECT campaign_id, locale, min(o_orderdate) AS scheduled_launch_time
FROM campaign JOIN orders ON campaign_id = o_custkey WHERE o_orderpriority = '1-URGENT' GROUP BY ALL"""
VIEWS["job_schedule"] = """
SELECT campaign_id, locale, max(o_orderdate) AS scheduled_launch_time
FROM campaign JOIN orders ON campaign_id = o_custkey GROUP BY ALL"""
VIEWS["enabled_locale"] = """
SELECT concat('EN_', upper(substr(r_name, 1, 2))) AS locale FROM region WHERE starts_with(r_name, 'A')"""
VIEWS["token_a"] = "SELECT c_custkey AS paid, md5(concat('a', c_custkey)) AS token FROM customer WHERE c_acctbal >= 4000"
VIEWS["token_b"] = """
SELECT c_custkey AS paid, md5(concat('b', c_custkey)) AS token FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')"""
VIEWS["loyalty"] = """
SELECT tpid, c_custkey AS paid, concat('M', c_custkey) AS member_id, c_mktsegment AS tier_name,
       CAST(floor(c_acctbal) AS BIGINT) AS available_points,
       CASE WHEN c_acctbal > 0 THEN 'Active' ELSE 'Closed' END AS status
FROM customer JOIN nations ON c_nationkey = n_nationkey WHERE c_mktsegment <> 'FURNITURE'"""
VIEWS["pos_mapping"] = """
SELECT DISTINCT tpid, eapid, CASE WHEN eapid = 0 THEN 'HOME' ELSE 'PARTNER' END AS brand,
       concat('P', tpid, ' ') AS posa FROM nations"""

VIEWS["test_assignment"] = """
SELECT test_id, test_type, k.tpid, k.eapid, k.locale, test_keys, segment_type_id, k.module_type_id,
       k.module_type_id * 10 + segment_type_id AS segment_module_map_id,
       CASE WHEN test_type = 'module version' AND arm = 1 THEN low
            WHEN test_type = 'module version' AND arm = 2 THEN high END AS module_id,
       arm AS control_test_flag, CASE WHEN arm = 0 THEN 'control' ELSE 'treatment' END AS t_c_flag
FROM (
  SELECT p.*, 1 AS test_id, 'module version' AS test_type, 1 AS segment_type_id, 1 AS module_type_id, test_keys % 3 AS arm
  FROM (SELECT DISTINCT tpid, eapid, locale, test_keys FROM traveler) p
  UNION ALL
  SELECT p.*, 2, 'module version', 6, 2, test_keys % 3 FROM (SELECT DISTINCT tpid, eapid, locale, test_keys FROM traveler) p
  UNION ALL
  SELECT p.*, 11, 'module type', 6, CASE WHEN test_keys % 2 = 0 THEN 5 ELSE 1 END, test_keys % 2
  FROM (SELECT DISTINCT tpid, eapid, locale, test_keys FROM traveler) p) k
LEFT JOIN (SELECT tpid, eapid, locale, module_type_id, min(module_id) AS low, max(module_id) AS high
           FROM module WHERE status = 'test published' GROUP BY ALL) m
  ON k.tpid = m.tpid AND k.eapid = m.eapid AND k.module_type_id = m.module_type_id"""

# Stages without content -------------------------------------------------------------

VIEWS["active_segment"] = "SELECT tpid, eapid, segment_type_id FROM segment WHERE segment_deleted_flag = 0"

VIEWS["live"] = f"SELECT * FROM campaign WHERE launch_date = {RUN_DATE} AND campaign_deleted_flag = 0"

_DEMOTED = """
SELECT c.* REPLACE (CASE WHEN s.segment_type_id IS NULL THEN 9999 ELSE c.priority END AS priority)
FROM {0} c LEFT JOIN active_segment s
  ON c.tpid = s.tpid AND c.eapid = s.eapid AND c.campaign_segment_type_id = s.segment_type_id"""
VIEWS["ready"] = _DEMOTED.format("live")
VIEWS["auto_live"] = """
SELECT * FROM live l WHERE NOT EXISTS (SELECT 1 FROM manual_launch m
  WHERE m.campaign_id = l.campaign_id AND m.locale = l.locale AND m.launch_date = l.launch_date)"""
VIEWS["run_campaign"] = _DEMOTED.format("auto_live")

VIEWS["matched"] = """
SELECT DISTINCT ts.*, c.campaign_id, c.priority
FROM traveler_segment ts JOIN ready c ON ts.segment_type_id = c.campaign_segment_type_id
  AND ts.tpid = c.tpid AND ts.eapid = c.eapid AND ts.locale = c.locale"""

_PROFILE = """
SELECT m.campaign_id, m.segment_type_id AS campaign_segment_type_id, m.segment_set,
       m.priority AS campaign_priority, t.*
FROM {0} m JOIN {1} t ON m.email_address = t.email_address AND m.test_keys = t.test_keys
  AND m.tpid = t.tpid AND m.eapid = t.eapid AND m.locale = t.locale"""
VIEWS["opted_in"] = "SELECT * FROM traveler WHERE mer_status = 1"
VIEWS["profile_rows"] = _PROFILE.format("matched", "opted_in")

_BEST = """
SELECT r.* FROM {0} r JOIN (
  SELECT email_address, campaign_id,
         row_number() OVER (PARTITION BY email_address ORDER BY campaign_priority, campaign_id) AS n FROM {0}) b
  ON r.email_address = b.email_address AND r.campaign_id = b.campaign_id AND b.n = 1"""
VIEWS["best_rows"] = _BEST.format("profile_rows")
VIEWS["recipients"] = """
SELECT * EXCLUDE (n) FROM (
  SELECT *, row_number() OVER (PARTITION BY email_address, paid ORDER BY campaign_id, user_id) AS n
  FROM best_rows WHERE campaign_priority <> 9999) WHERE n = 1"""
VIEWS["coded_recipients"] = "SELECT *, concat('1-', campaign_id, '_2-', test_keys) AS module_code FROM recipients"

_META = """
SELECT c.campaign_id, c.tpid, c.eapid, c.locale, c.campaign_segment_type_id, c.priority, c.audience_name,
       t.segment_module_map_id, t.slot_position, m.module_id, m.module_type_id, m.placement_type,
       s.segment_type_id, s.module_priority_in_slot, m.status, m.version, m.module_type, m.default_flag
FROM {0} c JOIN {1} t ON c.template_id = t.template_id AND t.template_deleted_flag = 0
JOIN segment_module_map s ON s.segment_module_map_id = t.segment_module_map_id AND s.seg_mod_deleted_flag = 0
JOIN module m ON m.module_type_id = s.module_type_id AND m.tpid = c.tpid AND m.eapid = c.eapid
  AND m.locale = c.locale AND m.placement_type = t.placement_type AND m.channel = t.channel
JOIN active_segment a ON a.tpid = c.tpid AND a.eapid = c.eapid AND a.segment_type_id = s.segment_type_id
WHERE m.status IN ('test published', 'active published')"""
VIEWS["plain_meta"] = _META.format("ready", "template")
VIEWS["plain_active"] = "SELECT * FROM plain_meta WHERE status = 'active published'"

# Stages of the decision -------------------------------------------------------------

VIEWS["template_copies"] = """
SELECT DISTINCT t.template_id, x.segment_module_map_id, t.slot_position, t.placement_type, t.channel, t.template_deleted_flag
FROM run_campaign c JOIN template t ON c.template_id = t.template_id AND t.template_deleted_flag = 0
JOIN segment_module_map s ON s.segment_module_map_id = t.segment_module_map_id AND s.seg_mod_deleted_flag = 0
JOIN (SELECT DISTINCT test_id, tpid, eapid, locale, module_type_id FROM test_assignment
      WHERE test_type = 'module type' AND control_test_flag = 0) k
  ON k.module_type_id = s.module_type_id AND k.tpid = c.tpid AND k.eapid = c.eapid
JOIN (SELECT DISTINCT test_id, tpid, eapid, segment_module_map_id FROM test_assignment
      WHERE test_type = 'module type' AND control_test_flag <> 0) x
  ON x.test_id = k.test_id AND x.tpid = k.tpid AND x.eapid = k.eapid"""
VIEWS["run_template"] = "SELECT * FROM template UNION SELECT * FROM template_copies"
VIEWS["meta"] = _META.format("run_campaign", "run_template")
VIEWS["active"] = "SELECT * FROM meta WHERE status = 'active published'"

VIEWS["run_traveler"] = """
SELECT * FROM opted_in t WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT * FROM notified UNION ALL SELECT * FROM booked) r
  WHERE r.email_address = lower(t.email_address) AND r.tpid = t.tpid AND r.eapid = t.eapid)"""
VIEWS["run_matched"] = """
SELECT DISTINCT ts.*, c.campaign_id, c.priority
FROM traveler_segment ts JOIN (SELECT DISTINCT campaign_id, campaign_segment_type_id, priority, tpid, eapid, locale FROM active) c
  ON ts.segment_type_id = c.campaign_segment_type_id AND ts.tpid = c.tpid AND ts.eapid = c.eapid"""
VIEWS["base"] = _PROFILE.format("run_matched", "run_traveler")

VIEWS["due"] = f"""
SELECT a.*, v.version_rank, n.ttl_versions
FROM active a
JOIN (SELECT DISTINCT campaign_id, slot_position, module_type_id, placement_type, version,
        dense_rank() OVER (PARTITION BY campaign_id, slot_position, module_type_id, placement_type ORDER BY version) AS version_rank
      FROM active) v USING (campaign_id, slot_position, module_type_id, placement_type, version)
JOIN (SELECT tpid, eapid, module_type_id, placement_type, count(DISTINCT version) AS ttl_versions
      FROM active GROUP BY ALL) n USING (tpid, eapid, module_type_id, placement_type)
WHERE EXISTS (SELECT 1 FROM module_variable x WHERE x.module_id = a.module_id)"""
VIEWS["content_set"] = """
SELECT k.*, CAST(unnest(string_split(segment_set, '#')) AS INT) AS seg
FROM (SELECT DISTINCT campaign_id, test_keys, segment_set, campaign_segment_type_id FROM base) k"""
VIEWS["allocated"] = f"""
SELECT {_CKEY}, s.campaign_segment_type_id, d.tpid, d.eapid, slot_position, module_type_id,
       module_priority_in_slot, min(module_id) AS module_id
FROM content_set s JOIN due d USING (campaign_id)
WHERE s.seg = d.segment_type_id AND version_rank = (test_keys + {SEED} % ttl_versions) % ttl_versions + 1
GROUP BY ALL"""

VIEWS["type_tested"] = f"""
SELECT * EXCLUDE (stays, n_stay) FROM (
  SELECT a.*, stays, sum(CASE WHEN stays THEN 1 ELSE 0 END) OVER (PARTITION BY {_CKEY}, slot_position) AS n_stay
  FROM (
    SELECT a.*, NOT EXISTS (SELECT 1 FROM test_assignment x WHERE x.test_type = 'module type'
                 AND x.module_type_id = a.module_type_id AND x.tpid = a.tpid AND x.eapid = a.eapid)
      OR EXISTS (SELECT 1 FROM test_assignment y WHERE y.test_type = 'module type'
                 AND y.module_type_id = a.module_type_id AND y.tpid = a.tpid AND y.eapid = a.eapid
                 AND y.test_keys = a.test_keys
                 AND contains('#' || a.segment_set || '#', '#' || y.segment_type_id || '#')) AS stays
    FROM allocated a) a)
WHERE stays OR n_stay = 0"""

VIEWS["placed"] = """
SELECT a.*, p.campaign_id, p.slot_position, p.campaign_segment_type_id
FROM test_assignment a LEFT JOIN (
  SELECT DISTINCT campaign_id, module_id, slot_position, campaign_segment_type_id
  FROM meta WHERE status = 'test published') p ON a.module_id = p.module_id
WHERE a.test_type = 'module version'"""
VIEWS["placed_tests"] = """
SELECT * FROM placed WHERE test_id IN (SELECT test_id FROM placed WHERE campaign_id IS NOT NULL)"""

VIEWS["replacement"] = """
SELECT campaign_id, test_keys, campaign_segment_type_id, module_type_id, slot_position,
       segment_type_id, min(module_id) AS module_id
FROM placed_tests WHERE t_c_flag <> 'control' AND campaign_id IS NOT NULL GROUP BY ALL"""
VIEWS["tested"] = f"""
SELECT a.* REPLACE (coalesce(r.module_id, a.module_id) AS module_id)
FROM type_tested a LEFT JOIN (
  SELECT b.{_CKEY.replace(', ', ', b.')}, b.slot_position, b.module_type_id, b.module_priority_in_slot,
         arg_max(x.module_id, x.segment_type_id) AS module_id
  FROM type_tested b JOIN replacement x ON x.campaign_id = b.campaign_id AND x.test_keys = b.test_keys
    AND x.campaign_segment_type_id = b.campaign_segment_type_id AND x.module_type_id = b.module_type_id
    AND x.slot_position = b.slot_position
    AND contains('#' || b.segment_set || '#', '#' || x.segment_type_id || '#')
  JOIN module old ON old.module_id = b.module_id JOIN module new ON new.module_id = x.module_id
  WHERE old.placement_type = new.placement_type
  GROUP BY ALL) r
USING ({_CKEY}, slot_position, module_type_id, module_priority_in_slot)"""

VIEWS["content_row"] = f"""
SELECT DISTINCT tpid, eapid, locale, {_CONTENT}, campaign_priority AS priority FROM base"""

VIEWS["candidate"] = f"""
SELECT c.*, a.slot_position AS slot, a.module_type_id, a.module_priority_in_slot AS own_priority, a.module_id,
       m.placement_type, m.default_flag
FROM content_row c JOIN tested a USING ({_CKEY}) JOIN module m ON m.module_id = a.module_id
WHERE EXISTS (SELECT 1 FROM module_variable x WHERE x.module_id = a.module_id)"""

_FILL = """replace(replace(replace(coalesce(v.var_structure, ''),
    '%%traveler.city%%', coalesce({0}.city, 'value_not_found')),
    '%%traveler.mktsegment%%', coalesce({0}.mktsegment, 'value_not_found')),
    '%%content.best%%', coalesce(l.best, 'value_not_found'))"""
VIEWS["cell"] = f"""
SELECT * EXCLUDE (parts, k, att, value), failed,
       CASE WHEN NOT failed THEN value WHEN slot = 1 AND pos = 1 THEN parts[1] ELSE 'None' END AS value,
       CASE WHEN failed OR k = 1 THEN 'default' ELSE CAST(att AS VARCHAR) END AS att
FROM (SELECT *, {_UNRESOLVED.format('value')} AS failed FROM (
  SELECT *, CASE WHEN k = 1 AND slot = 1 AND pos = 1 THEN parts[1] WHEN k = 1 THEN 'None' ELSE parts[2 + att] END AS value
  FROM (SELECT *, CASE WHEN k > 2 THEN (test_keys + {SEED} % (k - 1)) % (k - 1) ELSE 0 END AS att
  FROM (SELECT *, len(parts) AS k FROM (
    SELECT c.*, v.var_position AS pos, string_split({_FILL.format('c')}, '|') AS parts
    FROM candidate c JOIN module_variable v ON v.module_id = c.module_id
    LEFT JOIN content l ON l.city = c.city AND l.tpid = c.tpid AND l.eapid = c.eapid)))))"""

VIEWS["offer"] = f"""
SELECT * EXCLUDE (any_failed), CASE WHEN any_failed AND placement_type IN ('hero', 'banner') AND default_flag = 0
                               THEN 9999 ELSE own_priority END AS eff
FROM (SELECT {_CONTENT}, priority, slot, module_id, module_type_id, own_priority, placement_type, default_flag,
             bool_or(failed) AS any_failed,
             string_agg(concat('#S', slot, '_P', pos, '.', att), '' ORDER BY pos) AS att_option,
             max(CASE WHEN pos = 1 THEN value END) AS first_value
      FROM cell GROUP BY {_CONTENT}, priority, slot, module_id, module_type_id, own_priority, placement_type, default_flag)"""


def _slot(n: int) -> str:
    """Winner of slot n for each content row, given the picks of the slots before it."""
    joins = " ".join(
        f"LEFT JOIN pick{i} p{i} ON {_same('o', f'p{i}')}" for i in range(1, n)
    )
    used = " AND ".join(f"coalesce(p{i}.module_id, 999) <> o.module_id" for i in range(1, n)) or "TRUE"
    return f"""
SELECT * EXCLUDE (n), CASE WHEN spent AND placement_type = 'banner' THEN 999 ELSE raw_id END AS module_id,
       CASE WHEN spent AND placement_type = 'hero' THEN 9999 ELSE priority END AS slot_priority
FROM (SELECT o.* EXCLUDE (module_id), o.module_id AS raw_id, o.eff = 9999 AND o.default_flag = 0 AS spent,
        row_number() OVER (PARTITION BY o.city, o.mktsegment, o.campaign_id, o.test_keys, o.segment_set
                           ORDER BY o.eff, o.module_id, o.module_type_id) AS n
      FROM (SELECT * FROM offer WHERE slot = {n}) o {joins} WHERE {used}) WHERE n = 1"""


def _same(a: str, b: str) -> str:
    return " AND ".join(
        [f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in ("city", "mktsegment")]
        + [f"{a}.{c} = {b}.{c}" for c in ("campaign_id", "test_keys", "segment_set")]
    )


for _n in range(1, 5):
    VIEWS[f"pick{_n}"] = _slot(_n)
VIEWS["offered_slot"] = f"SELECT DISTINCT {_CONTENT}, slot FROM offer"
VIEWS["run_slot"] = "SELECT DISTINCT slot_position AS slot FROM active"
VIEWS["pick"] = f"""
SELECT c.tpid, c.eapid, c.locale, {', '.join('c.' + x for x in _CONTENT.split(', '))}, s.slot,
       coalesce(p.module_id, 999) AS module_id, p.raw_id, p.eff AS priority, p.module_type_id,
       coalesce(p.slot_priority, c.priority) AS slot_priority,
       CASE WHEN p.slot IS NOT NULL THEN NULL WHEN f.slot IS NOT NULL THEN 'pixel_module' ELSE 'None' END AS fill_reason,
       p.att_option, CASE WHEN p.module_id = 999 THEN 'None' ELSE p.first_value END AS first_value
FROM content_row c
JOIN (SELECT DISTINCT {_CONTENT} FROM offer) o ON {_same('c', 'o')}
CROSS JOIN run_slot s
LEFT JOIN (SELECT * FROM pick1 UNION ALL SELECT * FROM pick2 UNION ALL SELECT * FROM pick3 UNION ALL SELECT * FROM pick4) p
  ON {_same('c', 'p')} AND p.slot = s.slot
LEFT JOIN offered_slot f ON {_same('c', 'f')} AND f.slot = s.slot"""
VIEWS["coded"] = f"""
SELECT tpid, eapid, locale, {_CONTENT}, max(slot_priority) AS campaign_priority,
       string_agg(concat(slot, '-', module_id), '_' ORDER BY slot) AS module_code,
       min(CASE WHEN slot = 1 THEN module_id END) AS s1, min(CASE WHEN slot = 2 THEN module_id END) AS s2
FROM pick GROUP BY ALL"""
VIEWS["row_"] = f"""
SELECT b.* EXCLUDE (campaign_priority), c.campaign_priority, c.module_code, c.s1, c.s2
FROM base b JOIN coded c ON {_same('b', 'c')}"""
VIEWS["best_row"] = _BEST.format("row_")
VIEWS["winner"] = """
SELECT * FROM best_row WHERE campaign_priority <> 9999 AND coalesce(s1, 999) <> 999 AND coalesce(s2, 999) <> 999"""
VIEWS["fit_row"] = """
SELECT * FROM row_ WHERE campaign_priority <> 9999 AND coalesce(s1, 999) <> 999 AND coalesce(s2, 999) <> 999"""
VIEWS["winner_pick"] = """
SELECT DISTINCT w.campaign_id, p.module_id, w.module_code, w.test_keys, w.tpid, w.eapid, w.locale, p.slot
FROM winner w JOIN pick p ON """ + _same("w", "p")
VIEWS["master"] = """
SELECT campaign_type_id, campaign_id, audience_name AS campaign_name, template_id,
       campaign_segment_type_id AS segment_id, '2001-08-01 06:00:00' AS run_date,
       CAST(strftime(launch_date, '%Y%m%d') AS INT) AS campaign_date,
       'EML' AS subchannel, concat('PROG', campaign_segment_type_id) AS program,
       concat('CODE', tpid) AS campaign_code, CASE WHEN campaign_segment_type_id <> 5 THEN 'INTENT' END AS lob_intent,
       locale, CAST(strftime(launch_date, '%Y%m%d') AS INT) AS partition_date_key, 'prod' AS environment,
       '2001-08-01 06:00:00' AS load_date, dense_rank() OVER (ORDER BY launch_date, campaign_id) AS sid
FROM {0}"""
VIEWS["ready_master"] = VIEWS["master"].format("ready")
VIEWS["run_master"] = VIEWS["master"].format("run_campaign")
VIEWS["master"] = VIEWS["master"].format("campaign")
VIEWS["test_tags"] = """
SELECT w.*, CASE WHEN treated IS NOT NULL THEN concat(treated, '#', a.arm)
                 WHEN control IS NOT NULL THEN concat(control, '#0') ELSE '1#X' END AS test_tag
FROM (SELECT w.tpid, w.eapid, w.locale, w.test_keys, w.module_code, min(t.test_id) AS treated, min(c.test_id) AS control
      FROM winner_pick w LEFT JOIN placed_tests t ON t.module_id = w.module_id AND t.tpid = w.tpid AND t.eapid = w.eapid
      LEFT JOIN (SELECT DISTINCT module_id, module_type_id FROM active) y ON y.module_id = w.module_id
      LEFT JOIN (SELECT DISTINCT tpid, eapid, slot_position, module_type_id, test_id FROM placed_tests
                 WHERE slot_position IS NOT NULL) c
        ON c.slot_position = w.slot AND c.module_type_id = y.module_type_id AND c.tpid = w.tpid AND c.eapid = w.eapid
      GROUP BY ALL) w
LEFT JOIN (SELECT DISTINCT tpid, eapid, test_id, test_keys, control_test_flag AS arm FROM placed_tests) a
  ON a.test_id = w.treated AND a.test_keys = w.test_keys AND a.tpid = w.tpid AND a.eapid = w.eapid"""

_NAMES = re.compile(r"\b(" + "|".join(sorted(VIEWS, key=len, reverse=True)) + r")\b")


def _with(sql: str) -> str:
    """Put the views that a statement uses, directly or not, in front of it."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in dict.fromkeys(_NAMES.findall(re.sub(r"'[^']*'", "''", text))):
            if name not in order and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                need(VIEWS[name])
                if name not in order:
                    order.append(name)

    need(sql)
    if not order:
        return sql.strip()
    views = ",\n".join(f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in order)
    return f"WITH {views}\n{sql.strip()}"


_STAMP = "'%Y-%m-%d %H:%M:%S'"
_SQL: dict[str, str] = {}

_SQL["scan_pushdown"] = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderpriority = '1-URGENT'"""
_SQL["scan_parquet_pruned"] = "SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal > 0"
_SQL["scan_csv"] = "SELECT campaign_id, locale, audience_name FROM campaign"
_SQL["scan_multi_path"] = "SELECT source_name, is_complete, count(*) AS n_rows FROM run_log GROUP BY ALL"
_SQL["load_config_set"] = """
SELECT s_suppkey, s_name, s_nationkey, n_nationkey, n_name, n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
_LATEST = """
SELECT source_id, log_id, file_path FROM (
  SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY {1} DESC, log_id DESC) AS n
  FROM run_log WHERE is_complete = 1 AND source_name = '{0}') WHERE n = 1"""
_SQL["latest_run"] = _LATEST.format("purchase", "start_date")
_SQL["latest_run_by_end"] = _LATEST.format("view", "end_date")
_SQL["latest_batch"] = """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)"""
_SQL["run_log_rows"] = f"""
SELECT source_name, source_id, is_complete,
       CASE WHEN is_complete = 1 THEN 'Row ID created' ELSE 'Failed' END AS status,
       strftime((start_date AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles', {_STAMP}) AS start_date,
       strftime((end_date AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles', {_STAMP}) AS end_date,
       CASE WHEN is_complete = 1 THEN ' ' ELSE 'Error' END AS error_message,
       CASE WHEN is_complete = 1 THEN row_counts ELSE 0 END AS row_counts, file_path
FROM run_log"""
_SQL["flag_gate"] = """
SELECT campaign_id, priority FROM campaign
WHERE (SELECT max(CASE WHEN control_test_flag > 0 THEN 1 ELSE 0 END) FROM test_assignment) = 1"""

_SQL["live_campaigns"] = "SELECT campaign_id, tpid, priority FROM live"
_SQL["live_campaigns_program"] = """
SELECT campaign_id, program_type FROM live WHERE program_type = 'EML..PROG1.CODE0.INTENT'"""
_SQL["pos_filter"] = """
SELECT module_id, locale FROM module WHERE (tpid, eapid, locale) IN (SELECT (tpid, eapid, locale) FROM live)"""
_SQL["status_filter"] = "SELECT module_id, status FROM module WHERE status <> 'draft'"
_SQL["semi_in_list"] = """
SELECT email_address, test_keys, segment_type_id FROM traveler_segment
WHERE (tpid, eapid, locale, segment_type_id) IN (SELECT (tpid, eapid, locale, campaign_segment_type_id) FROM live)"""
_SQL["manual_campaign"] = """
SELECT campaign_id, locale, priority FROM run_campaign WHERE campaign_id = (SELECT min(campaign_id) FROM run_campaign)"""
_SQL["anti_manual_launch"] = """
SELECT campaign_id, locale FROM campaign WHERE campaign_id NOT IN (SELECT campaign_id FROM manual_launch)"""
_SQL["dead_segments"] = """
SELECT DISTINCT tpid, eapid, campaign_segment_type_id AS segment_type_id FROM live
WHERE (tpid, eapid, campaign_segment_type_id) NOT IN (SELECT (tpid, eapid, segment_type_id) FROM active_segment)"""
_SQL["demote_dead"] = f"SELECT campaign_id, priority FROM ({_DEMOTED.format('campaign')})"
_SQL["program_parts"] = """
SELECT campaign_id, subchannel, program, campaign_code, lob_intent FROM master"""
_SQL["date_compact"] = """
SELECT campaign_id, CAST(strftime(launch_date, '%Y%m%d') AS INT) AS campaign_date,
       strftime(launch_date, '%Y%m%d') AS issue_id FROM campaign"""
_SQL["locale_gate"] = f"""
SELECT campaign_id, locale, strftime(scheduled_launch_time, {_STAMP}) AS scheduled_launch_time FROM (
  SELECT * FROM schedule WHERE upper(locale) IN (SELECT locale FROM enabled_locale)
  UNION ALL SELECT * FROM job_schedule WHERE upper(locale) NOT IN (SELECT locale FROM enabled_locale))"""
_SQL["missing_schedule"] = """
SELECT campaign_id FROM campaign WHERE campaign_id NOT IN (SELECT campaign_id FROM schedule)"""
_SQL["audience_master"] = "SELECT * FROM master"

_SQL["recent_notified"] = "SELECT *, 0 AS strict FROM notified UNION ALL SELECT *, 1 FROM notified_strict"
_SQL["recent_booked"] = "SELECT *, 0 AS strict FROM booked UNION ALL SELECT *, 1 FROM booked_strict"
_SQL["eligible_travelers"] = "SELECT user_id, email_address FROM opted_in"
_SQL["suppress_recent"] = """
SELECT user_id, email_address, tpid, eapid FROM traveler t WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT * FROM notified UNION ALL SELECT * FROM booked) r
  WHERE r.email_address = lower(t.email_address) AND r.tpid = t.tpid AND r.eapid = t.eapid)"""
_SQL["union_all"] = """
SELECT email_address, tpid, eapid, count(*) AS n_contacts FROM (
  SELECT email_address, tpid, eapid FROM notification UNION ALL SELECT email_address, tpid, eapid FROM booking)
GROUP BY ALL"""

_SQL["output_projection"] = """
SELECT tpid AS "TPID", eapid AS "EAPID", locale, email_address AS "EmailAddress", first_name AS "FIRST_NAME",
       mer_status AS "IsMER", paid AS "PAID" FROM traveler"""
_SQL["normalize_strings"] = """
SELECT user_id, lower(first_name) AS name_lower, upper(locale) AS locale_upper,
       regexp_extract(email_address, '^[^@]*') AS mailbox, city || '#' || mktsegment AS pair_strict,
       CASE WHEN city IS NULL THEN mktsegment ELSE city || '#' || mktsegment END AS pair_skipping,
       replace(city, '_', ' ') AS city_text, city LIKE '%1%' AS has_one, mktsegment LIKE 'B%' AS starts_b,
       mktsegment AS trimmed FROM traveler"""
_SQL["none_to_null"] = "SELECT user_id, test_keys, city, mktsegment FROM traveler"
_SQL["filter_present"] = "SELECT user_id, city FROM traveler WHERE city IS NOT NULL AND paid IS NOT NULL"
_SQL["filter_like"] = """
SELECT p_partkey, p_name, p_brand FROM part WHERE p_name LIKE '%ring%' AND p_brand NOT LIKE 'Brand#1%'"""
_SQL["distinct_rows"] = "SELECT DISTINCT tpid, eapid, locale, city, mktsegment FROM traveler"
_SQL["set_except"] = """
SELECT tpid, eapid, locale, city FROM traveler WHERE city IS NOT NULL
EXCEPT SELECT tpid, eapid, locale, city FROM content WHERE best IS NOT NULL"""
_SQL["set_intersect"] = """
SELECT tpid, eapid, locale, segment_type_id FROM traveler_segment
INTERSECT SELECT tpid, eapid, locale, campaign_segment_type_id FROM live"""

_SQL["rotation_seed"] = """
SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS day,
       CAST(weekofyear(o_orderdate) + isodow(o_orderdate) - 1 AS INT) AS seed FROM orders"""
_SQL["tz_shift"] = f"""
SELECT log_id, strftime((start_date AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles', {_STAMP}) AS pacific,
       strftime((start_date AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Kolkata', {_STAMP}) AS india FROM run_log"""
_SQL["launch_date"] = """
SELECT log_id, strftime(CASE WHEN hour(p) > 20 THEN i ELSE p END, '%Y-%m-%d') AS launch_date FROM (
  SELECT log_id, (start_date AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS p,
         (start_date AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Kolkata' AS i FROM run_log)"""

_SQL["traveler_campaign"] = """
SELECT email_address, test_keys, campaign_id, segment_type_id AS campaign_segment_type_id, segment_set, priority FROM matched"""
_SQL["traveler_profile_join"] = """
SELECT user_id, campaign_id, campaign_segment_type_id, city, campaign_priority FROM profile_rows"""
_SQL["campaign_rank"] = "SELECT email_address, user_id, campaign_id, campaign_priority FROM best_rows"
_SQL["dedupe_recipient"] = """
SELECT email_address, paid, campaign_id, user_id FROM (SELECT *, row_number() OVER (
  PARTITION BY email_address, paid ORDER BY campaign_priority, campaign_id, user_id) AS n FROM profile_rows) WHERE n = 1"""
_SQL["campaign_head"] = """
SELECT campaign_id, test_keys, user_id FROM (SELECT *, row_number() OVER (
  PARTITION BY campaign_id ORDER BY test_keys, user_id) AS n FROM profile_rows) WHERE n <= 3"""
_SQL["output_name"] = """
SELECT campaign_id, unnest([audience_name, audience_name || '_MTS', audience_name || '_ATS',
  audience_name || '_BACKUP_' || strftime(launch_date, '%Y%m%d'), audience_name || '_PILOT']) AS output_name FROM campaign"""
_SQL["row_guards"] = """
SELECT *, n_rows > 0 AS ok FROM (
  SELECT 'campaigns' AS frame, count(*) AS n_rows FROM ready
  UNION ALL SELECT 'variables', count(*) FROM module_variable
  UNION ALL SELECT 'base', count(*) FROM profile_rows
  UNION ALL SELECT 'nobody', count(*) FROM opted_in WHERE locale = 'xx_xx')"""

_SQL["campaign_metadata"] = """
SELECT campaign_id, segment_module_map_id, slot_position, module_id, segment_type_id, module_priority_in_slot, status
FROM plain_meta"""
_SQL["version_count"] = """
SELECT tpid, eapid, locale, module_type_id, placement_type, CAST(count(DISTINCT version) AS INT) AS ttl_versions
FROM plain_active GROUP BY ALL"""
_SQL["version_rank"] = """
SELECT DISTINCT campaign_id, slot_position, module_type_id, placement_type, version,
  CAST(dense_rank() OVER (PARTITION BY campaign_id, slot_position, module_type_id, placement_type ORDER BY version) AS INT)
  AS version_rank FROM plain_active"""
_SQL["module_count"] = """
SELECT campaign_id, audience_name, count(DISTINCT slot_position) AS module_count FROM plain_active GROUP BY ALL"""
_SQL["module_count_join"] = """
SELECT user_id, campaign_id, module_count FROM recipients JOIN (
  SELECT campaign_id, count(DISTINCT slot_position) AS module_count FROM plain_active GROUP BY ALL) USING (campaign_id)"""
_SQL["slot_width"] = """
SELECT slot_position, max(var_position) AS var_positions
FROM plain_active LEFT JOIN module_variable USING (module_id) GROUP BY ALL"""
_SQL["slot_list"] = """
SELECT string_agg(CAST(slot_position AS VARCHAR), ',' ORDER BY slot_position) AS slots, CAST(count(*) AS INT) AS n_slots
FROM (SELECT DISTINCT slot_position FROM plain_active)"""
_SQL["module_variables"] = """
SELECT module_id, module_type, var_position, var_structure
FROM (SELECT DISTINCT module_id, module_type FROM plain_active) LEFT JOIN module_variable USING (module_id)"""
_SQL["missing_modules"] = """
SELECT DISTINCT module_id FROM plain_meta WHERE module_id NOT IN (SELECT module_id FROM module_variable)"""
_SQL["backfill_source"] = """
SELECT module_id, var_position, 'traveler.city|content.city' AS var_source FROM module_variable"""
_SQL["join_spec"] = """
SELECT module_id, var_position, 'content' AS file_name, 'city' AS left_keys, 'city' AS right_keys, 'best' AS columns
FROM module_variable WHERE contains(var_structure, '%%content.best%%')"""
_SQL["needed_columns"] = """
SELECT DISTINCT column_name FROM (
  SELECT unnest(['city']) AS column_name FROM module_variable
  UNION ALL SELECT 'mktsegment' FROM module_variable WHERE contains(var_structure, '%%traveler.mktsegment%%'))"""
_SQL["missing_files"] = """
SELECT DISTINCT 'content' AS file_name FROM module_variable
WHERE contains(var_structure, '%%content.') AND 'content' NOT IN (SELECT lower(r_name) FROM region)"""
_SQL["module_info"] = """
SELECT module_id, var_position AS position, source_connection AS connection, 'traveler.city|content.city' AS spec,
       CAST((length(coalesce(var_structure, '')) - length(replace(coalesce(var_structure, ''), '%%', ''))) // 4 AS INT) AS n_tokens
FROM module_variable"""

_ALLOC = f"SELECT {_CKEY}, slot_position, module_type_id, module_priority_in_slot, module_id FROM"
_SQL["segment_member"] = """
SELECT k.*, module_type_id FROM (
  SELECT DISTINCT tpid, eapid, test_keys, segment_set, CAST(unnest(string_split(segment_set, '#')) AS INT) AS segment_type_id
  FROM traveler_segment) k JOIN segment_module_map m USING (segment_type_id)"""
_SQL["allocate_modules"] = f"{_ALLOC} allocated"
_SQL["tests_on_campaign"] = """
SELECT test_id, tpid, eapid, test_keys, module_id, campaign_id, slot_position, control_test_flag FROM placed_tests"""
_SQL["test_module_set"] = """
SELECT tpid, eapid, locale, test_keys, segment_type_id,
       string_agg(CAST(module_type_id AS VARCHAR), '#' ORDER BY module_type_id) AS module_types
FROM (SELECT DISTINCT tpid, eapid, locale, test_keys, segment_type_id, module_type_id
      FROM test_assignment WHERE test_type = 'module type') GROUP BY ALL"""
_SQL["experiment_catalogue"] = """
SELECT test_id, test_type, tpid, eapid, locale, test_keys, module_type_id, control_test_flag
FROM test_assignment WHERE test_id <> 2"""
_SQL["campaigns_under_test"] = """
SELECT DISTINCT c.campaign_id
FROM run_campaign c JOIN run_template t ON c.template_id = t.template_id AND t.template_deleted_flag = 0
JOIN segment_module_map s ON s.segment_module_map_id = t.segment_module_map_id AND s.seg_mod_deleted_flag = 0
JOIN active_segment a ON a.tpid = c.tpid AND a.eapid = c.eapid AND a.segment_type_id = s.segment_type_id
WHERE s.segment_module_map_id IN (SELECT segment_module_map_id FROM test_assignment
                                  WHERE test_type = 'module type' AND control_test_flag = 0)"""
_SQL["expand_test_templates"] = "SELECT * FROM template UNION ALL SELECT * FROM template_copies"
_SQL["type_test_filter"] = f"{_ALLOC} type_tested"
_SQL["version_test_replace"] = f"{_ALLOC} tested"
_SQL["content_alloc_join"] = f"SELECT {_CONTENT}, CAST(count(*) AS INT) AS n_candidates FROM candidate GROUP BY ALL"

_SQL["content_lookup"] = """
SELECT t.*, 'content' AS file, l.best
FROM (SELECT DISTINCT tpid, eapid, locale, city, mktsegment FROM traveler) t
LEFT JOIN content l ON l.city = t.city AND l.tpid = t.tpid AND l.eapid = t.eapid"""
VIEWS["rendered"] = f"""
SELECT t.city, t.mktsegment, v.module_id, v.var_position, {_FILL.format('t')} AS text
FROM (SELECT DISTINCT tpid, eapid, locale, city, mktsegment, module_id FROM candidate) t
JOIN module_variable v ON v.module_id = t.module_id
LEFT JOIN content l ON l.city = t.city AND l.tpid = t.tpid AND l.eapid = t.eapid"""
_NAMES = re.compile(r"\b(" + "|".join(sorted(VIEWS, key=len, reverse=True)) + r")\b")
_SQL["render_template"] = "SELECT city, mktsegment, module_id, var_position, text FROM rendered"
_SQL["rotate_option"] = """
SELECT module_id, pos AS var_position, att AS option, count(*) AS n_shown, min(value) AS first_value FROM cell GROUP BY ALL"""
_SQL["content_fallback"] = f"""
SELECT city, mktsegment, module_id, var_position, {_UNRESOLVED.format('text')} AS unresolved,
       contains(lower(text), 'value_not_found') OR lower(text) = 'none' OR contains(lower(text), 'nan')
         OR contains(lower(text), 'null') AS unresolved_legacy,
       CASE WHEN {_UNRESOLVED.format('text')} THEN string_split(text, '|')[1] ELSE text END AS shown
FROM rendered"""
_SQL["dynamic_content"] = f"""
SELECT {', '.join('c.' + x for x in _CONTENT.split(', '))},
       coalesce('{{' || string_agg('"' || name || '":"' || value || '"', ',' ORDER BY name) || '}}', '{{}}') AS dynamic_content
FROM (SELECT DISTINCT {_CONTENT} FROM coded) c LEFT JOIN (
  SELECT {_CONTENT}, name, arg_max(value, slot * 100 + pos) AS value FROM (
    SELECT {', '.join('p.' + x for x in _CONTENT.split(', '))}, p.slot, v.var_position AS pos,
           unnest(['city_1', 'mktsegment_1', 'best_' || v.source_connection]) AS name,
           unnest([CASE WHEN contains(var_structure, '%%traveler.city%%') THEN p.city END,
                   CASE WHEN contains(var_structure, '%%traveler.mktsegment%%') THEN p.mktsegment END,
                   CASE WHEN contains(var_structure, '%%content.best%%') THEN l.best END]) AS value
    FROM pick p JOIN module_variable v ON v.module_id = p.module_id
    LEFT JOIN content l ON l.city = p.city AND l.tpid = p.tpid AND l.eapid = p.eapid
    WHERE p.module_id <> 999) WHERE value IS NOT NULL GROUP BY ALL) a
ON {_same('c', 'a')} GROUP BY ALL"""

_SQL["slot_winner"] = f"SELECT {_CONTENT}, CAST(slot AS INT) AS slot, module_id, priority, fill_reason FROM pick"
_SQL["hero_banner_rule"] = f"""
SELECT {_CONTENT}, max(slot_priority) AS campaign_priority,
       CAST(count(*) FILTER (WHERE priority = 9999) AS INT) AS n_spent,
       CAST(count(*) FILTER (WHERE priority = 9999 AND module_id = 999) AS INT) AS n_emptied FROM pick GROUP BY ALL"""
_SQL["module_code"] = f"SELECT {_CONTENT}, module_code FROM coded"
_SLOT_COLUMNS = ", ".join(
    f"max(CASE WHEN slot = {s} THEN module_id END) AS \"S{s}_module_id\", "
    f"max(CASE WHEN slot = {s} THEN coalesce(CAST(module_type_id AS VARCHAR), fill_reason) END) AS \"S{s}_module_type_id\", "
    f"max(CASE WHEN slot = {s} THEN coalesce(CAST(priority AS VARCHAR), fill_reason) END) AS \"S{s}_module_priority\", "
    f"max(CASE WHEN slot = {s} THEN coalesce(fill_reason, att_option) END) AS \"S{s}_att_option\""
    for s in range(1, 5)
)
_SQL["slot_columns"] = f"""
SELECT {_CONTENT}, max(CASE WHEN slot = 1 THEN coalesce(first_value, 'None') END) AS subject_line, {_SLOT_COLUMNS}
FROM pick GROUP BY {_CONTENT}"""
_SQL["content_fanout"] = "SELECT email_address, user_id, campaign_id, campaign_priority, module_code FROM row_"
_SQL["arbitrate"] = "SELECT email_address, user_id, campaign_id, campaign_priority, module_code FROM winner"
_SQL["arbitrate_rounds"] = f"""
SELECT 0 AS fallthrough, email_address, user_id, campaign_id, campaign_priority, module_code FROM winner
UNION ALL
SELECT 1, email_address, user_id, campaign_id, campaign_priority, module_code FROM ({_BEST.format('fit_row')})"""
_SQL["arbitrate_fallthrough"] = f"""
SELECT email_address, user_id, campaign_id, campaign_priority FROM ({_BEST.format('fit_row')})"""
_SQL["campaign_modules"] = "SELECT DISTINCT campaign_id, module_id FROM winner_pick"
_SUMMARY = """
SELECT campaign_id, audience_name, count(user_id) AS n_rows, CASE WHEN count(user_id) = 0 THEN 1 ELSE 0 END AS suppressed
FROM run_campaign LEFT JOIN (SELECT campaign_id, user_id FROM winner) USING (campaign_id) GROUP BY ALL"""
_SQL["campaign_summary"] = _SUMMARY
_SQL["launch_manifest"] = f"""
SELECT campaign_id, staging_filename, path, sid, strftime(scheduled_launch_time, {_STAMP}) AS scheduled_launch_time
FROM (SELECT campaign_id, audience_name AS staging_filename, concat('out/campaigns/launch_date=2001-08-01/audience=', regexp_replace(audience_name, '[^A-Za-z0-9_.-]', '_', 'g'), '/sid=', sid) AS path, sid
      FROM ({_SUMMARY}) s JOIN run_master USING (campaign_id)
      UNION ALL
      SELECT campaign_id, audience_name || '_modules', concat('out/modules/campaign_id=', campaign_id), sid
      FROM ({_SUMMARY}) s JOIN run_master USING (campaign_id) WHERE suppressed = 0)
JOIN schedule USING (campaign_id)"""
_SQL["test_tag"] = "SELECT tpid, eapid, locale, test_keys, module_code, test_tag FROM test_tags"
_SQL["rewrite_tag"] = """
SELECT user_id, campaign_id, concat('ID.PAID', paid, '.TEST', string_split(test_tag, '#')[1], '.VERS',
         string_split(test_tag, '#')[2], '.MIDS', module_code) AS recipient_id
FROM (SELECT * FROM winner WHERE paid IS NOT NULL) JOIN test_tags USING (tpid, eapid, locale, test_keys, module_code)
UNION ALL SELECT user_id, campaign_id, NULL FROM winner WHERE paid IS NULL"""
_SQL["sample_per_code"] = """
SELECT module_code, user_id, campaign_id FROM (SELECT *, row_number() OVER (PARTITION BY module_code
  ORDER BY md5(concat(user_id, '|', campaign_id, '|', segment_set)), user_id) AS n FROM winner) WHERE n <= 5"""

_SQL["launch_time"] = """
SELECT user_id, r.campaign_id, CAST(c.launch_date AS VARCHAR) AS launch_date, c.launch_time_utc
FROM recipients r JOIN campaign c ON c.campaign_id = r.campaign_id AND c.locale = r.locale"""
_SQL["token_coalesce"] = """
SELECT user_id, campaign_id, coalesce('emailclick/' || a.token || '/', 'emailclick/' || b.token || '/', '') AS user_token
FROM (SELECT * FROM recipients WHERE paid IS NOT NULL) LEFT JOIN token_a a USING (paid) LEFT JOIN token_b b USING (paid)"""
_SQL["loyalty_enrich"] = """
SELECT r.user_id, r.campaign_id, member_id, tier_name, available_points,
       CASE WHEN status = 'Active' THEN '1' ELSE '0' END AS member_status
FROM recipients r LEFT JOIN loyalty l ON l.paid = r.paid AND l.tpid = r.tpid"""
_SQL["loyalty_flag"] = "SELECT paid, CASE WHEN status = 'Active' THEN '1' ELSE '0' END AS member_status FROM loyalty"
_SQL["pos_mapping_join"] = """
SELECT user_id, campaign_id, 'prod' AS mode, brand, posa FROM recipients JOIN pos_mapping USING (tpid, eapid)
UNION ALL SELECT user_id, campaign_id, 'test', brand, 'X' FROM recipients JOIN pos_mapping USING (tpid, eapid)"""
_SQL["recipient_enrich"] = """
SELECT user_id, campaign_id,
       CASE WHEN mktsegment <> 'BUILDING' AND r.paid IS NOT NULL THEN md5(CAST(r.paid AS VARCHAR)) END AS user_token,
       member_id,
       CASE WHEN mktsegment <> 'MACHINERY' AND r.paid IS NOT NULL
            THEN concat('ID', r.paid, '.MIDS', module_code) END AS recipient_id
FROM coded_recipients r LEFT JOIN loyalty l ON l.paid = r.paid AND l.tpid = r.tpid"""
_SQL["pad_id"] = """
SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS padded,
       CASE WHEN w > 99999999 THEN CAST(w AS VARCHAR) ELSE lpad(CAST(w AS VARCHAR), 9, '0') END AS padded_wide,
       concat(o_custkey, lpad(CAST(o_orderkey AS VARCHAR), 9, '0')) AS key_id
FROM (SELECT *, o_orderkey * 100000 + o_custkey AS w FROM orders)"""
VIEWS["numbered"] = """
SELECT *, row_number() OVER (ORDER BY md5(concat(user_id, '|', campaign_id)), user_id) AS row_id FROM coded_recipients"""
_NAMES = re.compile(r"\b(" + "|".join(sorted(VIEWS, key=len, reverse=True)) + r")\b")
_SQL["row_ids"] = "SELECT email_address, user_id, campaign_id, row_id FROM numbered"
_SQL["recipient_id"] = """
SELECT user_id, campaign_id,
  CASE WHEN lob_intent IS NOT NULL AND paid IS NOT NULL THEN
    concat(CASE WHEN brand = 'HOME' THEN '' ELSE 'PARTNER-' END, trim(posa), '.', subchannel, '.', program, '.',
           campaign_code, '.', lob_intent, '&EMLDTL=DATE', campaign_date, '.SID', sid, '.KEY', sid,
           lpad(CAST(row_id AS VARCHAR), 9, '0'), '.PAID', paid, '.LANG', upper(n.locale), '.MCID',
           CASE WHEN mer_status = 1 THEN 'M' ELSE 'C' END, '.TEST1.VERSX.MIDS', module_code) END AS recipient_id
FROM numbered n JOIN pos_mapping USING (tpid, eapid) JOIN ready_master USING (campaign_id)"""
_SQL["seed_rows"] = """
SELECT tpid, eapid, locale, email_address, user_id, paid, test_keys, campaign_id FROM recipients
UNION ALL
SELECT r.tpid, r.eapid, r.locale, s.seed_email, r.user_id, 999999999, r.test_keys, r.campaign_id
FROM (SELECT *, row_number() OVER (PARTITION BY campaign_id ORDER BY test_keys, user_id) AS n FROM recipients) r
JOIN (SELECT *, row_number() OVER (PARTITION BY tpid, eapid, locale ORDER BY seed_email) AS n
      FROM seed WHERE is_active = 1 AND category = 'Merch') s
  ON s.n = r.n AND s.tpid = r.tpid AND s.eapid = r.eapid AND s.locale = r.locale"""
_SQL["redirect_address"] = """
SELECT user_id, campaign_id, email_address, 'prod' AS mode FROM recipients
UNION ALL SELECT user_id, campaign_id, 'check@example.com', 'test' FROM recipients"""
_SQL["stratified_sample"] = """
SELECT user_id, campaign_id, test_keys FROM profile_rows
WHERE CAST('0x' || substr(md5(concat(test_keys, '|', user_id, '|', campaign_id)), 1, 8) AS BIGINT) / 4294967296.0 < 0.01"""

VIEWS["quiet_rows"] = _PROFILE.format("matched", "run_traveler")
VIEWS["quiet_best"] = _BEST.format("quiet_rows")
_NAMES = re.compile(r"\b(" + "|".join(sorted(VIEWS, key=len, reverse=True)) + r")\b")
_SQL["travelers_per_campaign"] = """
SELECT campaign_id, count(DISTINCT user_id) AS n_travelers FROM quiet_best WHERE campaign_priority <> 9999 GROUP BY ALL"""

_SQL["audience_master_second_run"] = """
SELECT campaign_id, CAST(strftime(launch_date, '%Y%m%d') AS INT) AS campaign_date, locale,
  CASE WHEN launch_date <> DATE '2001-08-01' THEN dense_rank() OVER (PARTITION BY launch_date <> DATE '2001-08-01' ORDER BY launch_date, campaign_id)
    ELSE (SELECT count(DISTINCT campaign_id) FROM campaign WHERE launch_date <> DATE '2001-08-01')
      + dense_rank() OVER (PARTITION BY launch_date <> DATE '2001-08-01' ORDER BY launch_date, campaign_id) END AS sid
FROM campaign"""

ORACLES: dict[str, str] = {name: _with(sql) for name, sql in _SQL.items()}
# The domain in which modules have no default and most cities look nothing up.
for _usual, _demoting in (
    ("CAST(p_partkey // 10 % 2 AS INT) AS default_flag", "0 AS default_flag"),
    ("CASE WHEN n_nationkey % 5 <> 0 THEN best END AS best", "CASE WHEN n_nationkey % 5 = 1 THEN best END AS best"),
):
    assert _usual in ORACLES["arbitrate_rounds"]
    ORACLES["arbitrate_rounds"] = ORACLES["arbitrate_rounds"].replace(_usual, _demoting)
