"""Users, reports, contacts and files derived from the generated tables, in DuckDB SQL."""

from __future__ import annotations

from rolegauge.checks.sentences import EXTENSIONS
from rolegauge.checks.sql.base import PARTS, lst, strip

EXT = f"({lst(EXTENSIONS)})[n % 3 + 1]"


def choose(count: int, *values: str) -> str:
    cases = " ".join(f"WHEN n % {count} = {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {cases} END"


PARTS["k_users"] = """
SELECT user_id AS id, CASE WHEN user_id = (SELECT min(user_id) FROM events) THEN 'admin' ELSE 'user_' || user_id END AS username
FROM (SELECT DISTINCT user_id FROM events) WHERE user_id % 13 <> 5
"""

PARTS["k_reports"] = f"""
SELECT n AS id, CASE WHEN user_id % 10 <> 0 THEN user_id END AS user_id, 'cv_' || n || '.' || {EXT} AS filename, ts AS uploaded_at,
  CASE WHEN n % 50 <> 0 THEN CAST(least(100, floor(value)) AS INTEGER) END AS score,
  {choose(10, '''[{'title': 'Data Analyst', 'match_score': CAST(n % 100 AS VARCHAR)}, {'title': 'Role ' || n, 'match_score': '7'}]''',
          '''[{'title': 'True None ' || n, 'match_score': '7.5'}, {'title': '', 'match_score': NULL}]''', '[]',
          '''[{'title': 'Data Analyst', 'match_score': NULL}, {'title': 'Role ' || n, 'match_score': NULL}]''', '[]', "[{'title': 'Mixed', 'match_score': '3'}]",
          '[]', '[]', """[{'title': 'AA it''s ' || n, 'match_score': '10'}]""",
          """[{'title': 'Legacy Role ' || n, 'match_score': NULL}, {'title': 'Second', 'match_score': NULL}]""")} AS jobs,
  {choose(10, "'Data Analyst, Role ' || n", "'True None ' || n", "'None'", "'Data Analyst, Role ' || n", "'None'", "'Plain ' || n || ', Mixed'",
          "'ab, z, 5, c ' || n", "'None'", "'AA it''s ' || n", "'Legacy Role ' || n || ', Second'")} AS summary,
  {choose(4, "[{'name': 'Skills', 'value': (n % 11) || '.5'}, {'name': 'Education', 'value': '4'}]", "[{'name': 'Education', 'value': CAST(n % 7 AS VARCHAR)}]", '[]', '[]')} AS criteria,
  {choose(5, "['Add detail ' || n, 'Use numbers']", '[]', '[]', '[]', "['Legacy advice']")} AS suggestions,
  n % 3 = 0 AS analyzed
FROM (SELECT *, event_id AS n FROM events)
"""

PARTS["k_keys"] = """
SELECT min(id) FILTER (username = 'admin') AS admin_id,
       coalesce(min(id) FILTER (username <> 'admin'), min(id) FILTER (username = 'admin')) AS primary_id FROM k_users
"""
PARTS["k_access"] = """
SELECT id AS viewer_id, id AS owner_id FROM k_users
UNION ALL SELECT primary_id, admin_id FROM k_keys WHERE primary_id <> admin_id
"""
PARTS["k_recent"] = """
SELECT a.viewer_id, r.*, row_number() OVER (PARTITION BY a.viewer_id ORDER BY r.uploaded_at DESC, r.id DESC) AS place
FROM k_reports r JOIN k_access a ON r.user_id = a.owner_id QUALIFY place <= 20
"""
PARTS["k_contacts"] = """
SELECT conv_id * 1000 + turn AS id, conv_id % 200 AS user_id, CASE WHEN conv_id % 23 = 3 THEN '  ' ELSE 'Sender ' || conv_id END AS name,
  CASE WHEN conv_id % 7 = 0 THEN 'not-an-email-' || conv_id ELSE ' sender' || conv_id || '@example.org ' END AS email,
  'Topic ' || turn AS subject, text AS message, 1704067200 + conv_id * 3600 + turn * 60 AS created_s
FROM conversations
"""
PARTS["k_lines_out"] = """
SELECT id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS line_no FROM (
  SELECT id, list_concat(
    ['Document Scoring Report', 'File: ' || filename, 'Saved: ' || strftime(uploaded_at, '%Y-%m-%dT%H:%M:%S') || '+00:00',
     'Score: ' || coalesce(CAST(score AS VARCHAR), 'None') || ' / 100', '', 'Criteria'],
    flatten(list_transform(criteria, lambda c: CASE WHEN analyzed AND c.name = 'Skills'
      THEN ['- ' || c.name || ': ' || c.value || '/10', '  Detected explicit skills.'] ELSE ['- ' || c.name || ': ' || c.value || '/10'] END)),
    ['', 'Suggestions'],
    CASE WHEN len(suggestions) > 0 THEN list_transform(suggestions, lambda s: '- ' || s) ELSE ['- No suggestions saved.'] END,
    CASE WHEN analyzed THEN ['', 'Suggested Bullet Rewrites', '- Before: Helped', '  After: Delivered ' || id,
                             '', 'Analysis Steps', '- Parsed: ' || id || ' words'] ELSE [] END,
    ['', 'Matches'], list_transform(jobs, lambda j: '- ' || j.title || ': ' || coalesce(j.match_score, '0') || '%')) AS lines
  FROM k_reports)
"""

# Files: the same bytes as text; the Spark side works on binary.
NAMES = ["'file_' || n || '.pdf'", "'file_' || n || '.DOCX'", "'file.' || n || '.txt'", "'file_' || n", "'file_' || n || '.exe'"]
PARTS["k_files"] = f"""
SELECT n AS doc_id, {choose(5, *NAMES)} AS filename, {choose(4, "'%PDF-1.7 '", "'PK' || chr(3) || chr(4)", "'a' || chr(0) || 'b'", "''")} || text AS body,
       length(text) * 5000 AS size
FROM (SELECT *, doc_id AS n FROM documents)
"""
PARTS["k_typed_files"] = """
SELECT *, CASE WHEN contains(filename, '.') THEN lower(regexp_extract(filename, '[^.]*$')) END AS ext FROM k_files
"""
PARTS["k_signed_files"] = """
SELECT *, coalesce(CASE ext WHEN 'pdf' THEN starts_with(body, '%PDF-') WHEN 'docx' THEN starts_with(body, 'PK' || chr(3) || chr(4))
  WHEN 'txt' THEN NOT contains(substr(body, 1, 3), chr(0)) ELSE false END, false) AS fits FROM k_typed_files
"""

PARTS["k_attempts"] = """
SELECT event_type AS action, user_id AS client, event_id, epoch_us(ts) AS at_us,
       row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS n FROM events
"""
LIMIT, SECONDS = 3, 86400
PARTS["k_limited"] = f"""
SELECT action, client, event_id, n, true AS accepted, [at_us] AS kept FROM k_attempts WHERE n = 1
UNION ALL
SELECT a.action, a.client, a.event_id, a.n, len(list_filter(k.kept, lambda t: a.at_us - t < {SECONDS}::BIGINT * 1000000)) < {LIMIT},
       CASE WHEN len(list_filter(k.kept, lambda t: a.at_us - t < {SECONDS}::BIGINT * 1000000)) < {LIMIT}
            THEN list_append(list_filter(k.kept, lambda t: a.at_us - t < {SECONDS}::BIGINT * 1000000), a.at_us)
            ELSE list_filter(k.kept, lambda t: a.at_us - t < {SECONDS}::BIGINT * 1000000) END
FROM k_limited k JOIN k_attempts a ON a.action = k.action AND a.client = k.client AND a.n = k.n + 1
"""
PARTS["k_new_names"] = """
SELECT conv_id * 1000 + turn AS n, CASE conv_id % 5 WHEN 0 THEN 'user_' || (conv_id % 150) WHEN 1 THEN 'guest.' || (conv_id % 40)
  WHEN 2 THEN ' a' || (conv_id % 7) || ' ' WHEN 3 THEN 'bad name ' || conv_id ELSE 'conv-' || conv_id END AS username FROM conversations
"""
STRIPPED_NAME = strip("username")
