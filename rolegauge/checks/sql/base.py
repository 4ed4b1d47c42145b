"""The same definitions in DuckDB SQL, written independently of the Spark plans: unnested rows, joins and groups.

``compose`` puts the named sub-queries a statement mentions, and those they mention, in front of it.
"""

from __future__ import annotations

import re

from rolegauge import lexicon as L
from rolegauge.checks.sentences import AS_OF_YEAR, EXTENSIONS, REQUIREMENTS, SNIPPETS, TITLES
from rolegauge.functions.experience import MONTH

LEX = L.DEFAULT
WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
FREE = r"[^a-z0-9+#.\-]"
EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
CONTACT = EMAIL + r"|\+?\p{Nd}[\p{Nd}\s\x0b\x1c-\x1f\x{85}\p{Z}().\-]{6,}\p{Nd}"
METRIC = r"\p{Nd}|%|\$|increased|reduced|improved|optimized"


def q(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]" if values else "[]::VARCHAR[]"


def names(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def norm(x: str) -> str:
    return f"trim(lower(regexp_replace({x}, '{WS}+', ' ', 'g')))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def compact(x: str, limit: int = 150) -> str:
    c = f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"
    return f"CASE WHEN length({c}) > {limit} THEN rtrim(substr({c}, 1, {limit - 3})) || '...' ELSE {c} END"


def alt(values) -> str:
    return "|".join(re.sub(r"([.+*?^$()\[\]{}|\\-])", r"\\\1", v) for v in values)


def found(pairs) -> str:
    """A list of the values whose condition holds, in order."""
    cases = ", ".join(f"CASE WHEN {condition} THEN {q(value)} END" for condition, value in pairs)
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


def contained(text: str, values) -> str:
    return found([(f"contains({text}, {q(v)})", v) for v in values])


def times(text: str, value: str) -> str:
    return f"((length({text}) - length(replace({text}, {q(value)}, ''))) // {len(value)})"


def skills(text: str) -> str:
    return found(
        [(f"regexp_matches({text}, '(^|{FREE})(?:{alt(a)})($|{FREE})')", name) for name, a in LEX.skills.items()]
    )


def ascii_letters(text: str) -> str:
    """Letters outside a-z as underscores: the engine's word borders know ASCII only."""
    return f"regexp_replace({text}, '[^\\P{{L}}a-zA-Z]', '_', 'g')"


def ordered_distinct(values: str) -> str:
    return f"list_filter({values}, lambda x, i: list_position({values}, x) = i)"


def half_even(x: str) -> str:
    return f"CAST(round_even({x}, 0) AS INTEGER)"


def clip(x: str, upper: int) -> str:
    return f"CAST(least(greatest(round_even({x}, 0), 0), {upper}) AS INTEGER)"


BASE_TOKEN = r"\b[a-zA-Z][a-zA-Z+#.\-]+\b"
DATE = rf"(?:{MONTH})?\s*(?:19|20)[0-9]{{2}}"
RANGE = rf"({DATE})\s*(?:-|–|—|to|until)\s*(present|current|now|{DATE})"


def tokens(wtext: str) -> str:
    return f"list_filter(regexp_extract_all({wtext}, '{BASE_TOKEN}'), lambda t: t NOT IN {names(LEX.stop_words)})"


def weights(role: str | None) -> str:
    return "[" + ", ".join(f"{w!r}::DOUBLE" for w in LEX.normalized_weights(role)) + "]"


def weight_case(title: str) -> str:
    cases = " ".join(f"WHEN contains({title}, {q(role)}) THEN {weights(role)}" for role in LEX.role_weights)
    return f"CASE {cases} ELSE {weights(None)} END"


def hint_list(title: str) -> str:
    parts = ", ".join(f"CASE WHEN contains({title}, {q(r)}) THEN {lst(h)} ELSE []::VARCHAR[] END" for r, h in LEX.role_hints.items())
    return f"flatten([{parts}])"


PARTS: dict[str, str] = {}

PARTS["k_corpus"] = f"""
SELECT d.doc_id,
       d.text || chr(10) || ({lst(SNIPPETS)})[d.doc_id % {len(SNIPPETS)} + 1] AS raw_text,
       ({lst(EXTENSIONS)})[d.doc_id % {len(EXTENSIONS)} + 1] AS ext,
       ({lst(TITLES)})[d.doc_id % {len(TITLES)} + 1] AS raw_title,
       CASE WHEN d.doc_id % 5 <> 0
            THEN concat_ws(' ', b.text, ({lst(REQUIREMENTS)})[d.doc_id % {len(REQUIREMENTS)} + 1]) END AS raw_description,
       CASE WHEN d.doc_id % 11 <> 0 THEN d.doc_id % 37 END AS user_id,
       'cv_' || d.doc_id || '.' || ({lst(EXTENSIONS)})[d.doc_id % {len(EXTENSIONS)} + 1] AS filename,
       1735689600 + d.doc_id * 3600 AS uploaded_s
FROM documents d
LEFT JOIN benchmark b ON b.item_id = d.doc_id % (SELECT count(*) FROM benchmark)
"""

PARTS["k_named"] = f"""
SELECT *, {norm('raw_text')} AS text, {strip('raw_title')} AS title, {strip('raw_description')} AS description,
       {strip("coalesce(raw_title, '') || ' ' || coalesce(raw_description, '')")} AS plain_target
FROM k_corpus
"""

PARTS["k_hinted"] = f"""
SELECT *, {norm('plain_target')} AS target, {hint_list(norm("coalesce(title, '')"))} AS all_hints FROM k_named
"""

PARTS["k_docs"] = f"""
SELECT * EXCLUDE (all_hints), {ordered_distinct('all_hints')} AS hints,
       CASE WHEN target <> '' THEN {norm("plain_target || ' ' || array_to_string(" + ordered_distinct('all_hints') + ", ' ')")}
            ELSE '' END AS role_text,
       {ascii_letters('text')} AS wtext, {skills('text')} AS skills
FROM k_hinted
"""

DEFAULTS = ", ".join(f"({n}, {q(t)}, {q(k)}, {q(d)})" for n, (t, k, d) in enumerate(L.DEFAULT_ROLES))
LONG = f"list_filter({tokens(ascii_letters(norm('text')))}, lambda t: length(t) > 4)"
PARTS["k_catalog"] = f"""
SELECT * FROM (VALUES {DEFAULTS}) AS v(job_id, title, keywords, description)
UNION ALL
SELECT item_id + 5, 'Role ' || item_id, array_to_string({ordered_distinct(LONG)}, ', '), text FROM benchmark
"""

PARTS["k_roles"] = f"""
SELECT job_id, title, description,
       list_filter(list_transform(string_split(keywords, ','), lambda k: {strip('k')}), lambda k: k <> '') AS keywords
FROM k_catalog
"""

PARTS["k_texts"] = f"""
SELECT 'doc' AS src, doc_id AS id, text FROM k_docs
UNION ALL SELECT 'target', doc_id, target FROM k_docs WHERE target <> ''
UNION ALL SELECT 'role', doc_id, role_text FROM k_docs WHERE target <> ''
UNION ALL SELECT 'job', job_id, {norm("title || ' ' || description || ' ' || array_to_string(keywords, ' ')")} FROM k_roles
"""

PARTS["k_analyzed"] = f"""
SELECT src, id, {ascii_letters('text')} AS wtext, {skills('text')} AS skills FROM k_texts
"""

PARTS["k_token_lists"] = f"""
SELECT *, list_concat({tokens('wtext')}, flatten(list_transform(skills, lambda s: string_split(s, ' ')))) AS terms
FROM k_analyzed
"""

PARTS["k_tokens"] = """
SELECT src, id, unnest(terms) AS term, generate_subscripts(terms, 1) AS pos FROM k_token_lists
"""

PARTS["k_phrases"] = rf"""
SELECT src, id, trim(phrase) AS phrase, pos FROM (
  SELECT src, id, unnest(p) AS phrase, generate_subscripts(p, 1) AS pos FROM (
    SELECT src, id, regexp_extract_all(wtext, '\b(?:required|must have|proficient in|experience with|responsible for)\s+([^.;:\n]+)', 1) AS p
    FROM k_analyzed))
"""

PARTS["k_phrase_tokens"] = f"""
SELECT src, id, unnest(t) AS term, pos * 1000000 + generate_subscripts(t, 1) AS pos FROM (
  SELECT src, id, pos,
         list_concat({tokens('phrase')}, flatten(list_transform({skills('phrase')}, lambda s: string_split(s, ' ')))) AS t
  FROM k_phrases)
"""

PARTS["k_bag"] = """
SELECT src, id, term, 1 AS w, 1 AS phase, pos FROM k_tokens
UNION ALL SELECT src, id, unnest(skills), 3, 2, generate_subscripts(skills, 1) FROM k_analyzed
UNION ALL SELECT src, id, term, 2, 3, pos FROM k_phrase_tokens
"""

PARTS["k_terms"] = """
SELECT src, id, term, CAST(sum(w) AS BIGINT) AS weight, min(phase * 1000000000000 + pos) AS first_pos
FROM k_bag GROUP BY src, id, term
"""

PARTS["k_plain"] = "SELECT src, id, term, count(*) AS weight FROM k_tokens GROUP BY src, id, term"

PARTS["k_norms"] = "SELECT src, id, CAST(sum(weight * weight) AS BIGINT) AS squared FROM k_terms GROUP BY src, id"
PARTS["k_plain_norms"] = "SELECT src, id, CAST(sum(weight * weight) AS BIGINT) AS squared FROM k_plain GROUP BY src, id"

PARTS["k_similarity"] = """
SELECT d.doc_id,
       coalesce(p.dot / (sqrt(pa.squared) * sqrt(pb.squared)), 0.0) AS plain_similarity,
       coalesce(w.dot / (sqrt(wa.squared) * sqrt(wb.squared)), 0.0) AS role_similarity
FROM k_docs d
LEFT JOIN (SELECT a.id, CAST(sum(a.weight * b.weight) AS BIGINT) AS dot FROM k_plain a
           JOIN k_plain b ON a.src = 'doc' AND b.src = 'target' AND a.id = b.id AND a.term = b.term GROUP BY a.id) p ON p.id = d.doc_id
LEFT JOIN (SELECT a.id, CAST(sum(a.weight * b.weight) AS BIGINT) AS dot FROM k_terms a
           JOIN k_terms b ON a.src = 'doc' AND b.src = 'role' AND a.id = b.id AND a.term = b.term GROUP BY a.id) w ON w.id = d.doc_id
LEFT JOIN k_plain_norms pa ON pa.src = 'doc' AND pa.id = d.doc_id
LEFT JOIN k_plain_norms pb ON pb.src = 'target' AND pb.id = d.doc_id
LEFT JOIN k_norms wa ON wa.src = 'doc' AND wa.id = d.doc_id
LEFT JOIN k_norms wb ON wb.src = 'role' AND wb.id = d.doc_id
WHERE d.target <> ''
"""

PARTS["k_ranges"] = rf"""
SELECT doc_id, pos, CAST(regexp_extract(s, '(?:19|20)[0-9][0-9]') AS INTEGER) AS start_year,
       CASE WHEN e IN ('present', 'current', 'now') THEN {AS_OF_YEAR}
            ELSE CAST(regexp_extract(e, '(?:19|20)[0-9][0-9]') AS INTEGER) END AS end_year,
       regexp_matches(context, '{alt(L.WORK_CONTEXT_WORDS)}') AS at_work
FROM (
  SELECT doc_id, i // 2 AS pos, regexp_extract(parts[i], '{RANGE}', 1) AS s, regexp_extract(parts[i], '{RANGE}', 2) AS e,
         right(array_to_string(parts[1:i-1], ''), 80) || parts[i] || left(array_to_string(parts[i+1:len(parts)], ''), 80) AS context
  FROM (SELECT doc_id, parts, unnest(range(2, len(parts) + 1, 2)) AS i FROM (
    SELECT doc_id, string_split(regexp_replace(text, '{RANGE}', chr(1) || '\0' || chr(1), 'g'), chr(1)) AS parts FROM k_docs)))
WHERE regexp_extract(s, '(?:19|20)[0-9][0-9]') <> ''
"""

PARTS["k_kept_ranges"] = f"""
SELECT * FROM k_ranges WHERE end_year >= start_year AND start_year >= 1970 AND end_year <= {AS_OF_YEAR}
"""

EXPLICIT_SQL = r"""coalesce(nullif(regexp_extract(wtext, '\b([0-9]{1,2})\+?\s*(?:years|yrs)(?:\s+of)?\s+(?:work\s+)?experience\b', 1), ''),
  nullif(regexp_extract(wtext, '\bexperience(?:\s+of|\s*:)?\s*([0-9]{1,2})\+?\s*(?:years|yrs)\b', 1), ''))"""
PARTS["k_explicit"] = f"SELECT doc_id, CASE WHEN x IS NOT NULL THEN least(CAST(x AS INTEGER), 25) END AS years FROM (SELECT doc_id, {EXPLICIT_SQL} AS x FROM k_docs)"

PARTS["k_years"] = """
SELECT e.doc_id, coalesce(e.years, least(coalesce(r.n, 0), 25))::INTEGER AS years
FROM k_explicit e LEFT JOIN (
  SELECT doc_id, count(DISTINCT y) AS n FROM (
    SELECT doc_id, unnest(range(start_year, end_year)) AS y FROM k_kept_ranges WHERE at_work) GROUP BY doc_id) r USING (doc_id)
"""


def word_list(values) -> str:
    return found([(rf"regexp_matches(wtext, '\b{v}\b')", v) for v in sorted(values)])


PARTS["k_profile"] = rf"""
SELECT d.doc_id, d.skills, y.years,
       {word_list(LEX.action_verbs)} AS action_verbs,
       {contained('text', sorted(LEX.weak_verbs))} AS weak_verbs,
       {contained('text', sorted(L.EDUCATION_WORDS))} AS education,
       len(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+')) AS word_count
FROM k_docs d JOIN k_years y USING (doc_id)
"""

CONTACT_HIT = f"regexp_matches(text, '{CONTACT}')"
LINK_HIT = "(" + " OR ".join(f"contains(text, {q(v)})" for v in L.PROFILE_LINKS) + ")"
BULLETS = "(" + " + ".join(times("text", v) for v in ("- ", "•", "* ")) + ")"
TYPOS = "(" + " + ".join(times("text", v) for v in LEX.typos) + ")"
DATES = r"len(regexp_extract_all(wtext, '\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec|[0-9]{4})\b'))"
YEARS = r"len(regexp_extract_all(wtext, '\b(?:19|20)[0-9]{2}\b'))"
IMPACT = rf"len(regexp_extract_all(wtext, '\b(?:{alt(LEX.impact_verbs)})\b'))"

PARTS["k_signals"] = f"""
SELECT d.*, p.years, p.action_verbs, p.weak_verbs, p.education, p.word_count, s.plain_similarity, s.role_similarity,
       {CONTACT_HIT} AS contact_found, {LINK_HIT} AS link_found, {BULLETS} AS n_bullets, {TYPOS} AS n_typos,
       {DATES} AS n_dates, {YEARS} AS n_years, {IMPACT} AS n_impact,
       {contained('text', L.SUMMARY_MARKERS)} AS summary_marks, {contained('text', L.DEGREE_WORDS)} AS degrees,
       {contained('text', LEX.general_keywords)} AS keyword_marks, {contained('text', LEX.listed_skills)} AS listed
FROM k_docs d JOIN k_profile p USING (doc_id) LEFT JOIN k_similarity s USING (doc_id)
"""

SCHOOL = "contains(text, 'high school')"
PARTS["k_criteria"] = f"""
SELECT *,
  (CASE WHEN contact_found THEN 5 ELSE 0 END + CASE WHEN link_found THEN 5 ELSE 0 END)::INTEGER AS contact,
  least(10, len(summary_marks) * 2)::INTEGER AS summary,
  (CASE WHEN years >= 5 AND n_impact >= 3 THEN 10 WHEN years >= 2 AND n_impact >= 2 THEN 8
        WHEN n_bullets >= 4 AND n_impact >= 3 THEN 10 WHEN n_bullets >= 2 AND n_impact >= 2 THEN 8
        WHEN n_bullets >= 1 AND n_impact >= 1 THEN 6 WHEN contains(text, 'experience') THEN 3 ELSE 0 END)::INTEGER AS experience,
  least(10, least(10, len(degrees) * 2 + least(n_years, 2) * 2)
        + CASE WHEN contains(text, 'gpa') AND len({contained('text', L.GPA_VALUES)}) > 0 THEN 2 ELSE 0 END)::INTEGER AS education_score,
  least(10, (len(skills) + len(list_filter(listed, lambda s: NOT list_contains(skills, s)))) * 2)::INTEGER AS skills_score,
  least(10, len(keyword_marks) * 2)::INTEGER AS keywords,
  (CASE WHEN n_bullets >= 3 AND n_dates >= 2 THEN 10 WHEN n_bullets >= 2 THEN 6 ELSE 4 END)::INTEGER AS consistency,
  (10 - least(6, n_typos))::INTEGER AS proofreading,
  (CASE WHEN ext IN ('pdf', 'docx') THEN 10 ELSE 7 END)::INTEGER AS file_format,
  (CASE WHEN target <> '' THEN {clip('plain_similarity * 18', 10)}
        WHEN {SCHOOL} AND (contains(text, 'bachelor') OR contains(text, 'master') OR contains(text, 'university') OR contains(text, 'college')) THEN 6
        WHEN {SCHOOL} AND NOT contains(text, 'degree') THEN 4 ELSE 10 END)::INTEGER AS relevance
FROM k_signals
"""

PARTS["k_valued"] = f"""
SELECT *, [contact, summary, experience, education_score, skills_score, keywords, consistency, proofreading, file_format, relevance] AS vals,
       {weight_case(norm("coalesce(title, '')"))} AS weights
FROM k_criteria
"""


def total(weight) -> str:
    return clip("(" + "0.0::DOUBLE + " + " + ".join(f"vals[{i}] * {weight(i)}" for i in range(1, 11)) + ") * 10", 100)


PARTS["k_scored"] = f"""
SELECT *, {total(lambda i: f'weights[{i}]')} AS score,
       {total(lambda i: repr(LEX.weights[L.CRITERION_KEYS[i - 1]]) + '::DOUBLE')} AS default_score
FROM k_valued
"""


def _reasons() -> dict[str, str]:
    def first(values: str, n: int) -> str:
        return f"array_to_string(({values})[1:{n}], ', ')"

    smarks = contained("text", L.SUMMARY_REASON_MARKERS)
    degrees = contained("text", L.DEGREE_REASON_WORDS)
    typos = contained("text", LEX.typos)
    return {
        "contact": """CASE WHEN contact_found AND link_found THEN 'Found direct contact details plus a portfolio, LinkedIn, or GitHub signal.'
            WHEN contact_found THEN 'Found email or phone details; add LinkedIn, GitHub, or portfolio when relevant.'
            WHEN link_found THEN 'Found a profile link, but no clear email or phone number was detected.'
            ELSE 'No clear email, phone, LinkedIn, GitHub, or portfolio signal was detected.' END""",
        "summary": f"""CASE WHEN summary >= 7 THEN 'Detected summary-style signals: ' || {first(smarks, 4)} || '.'
            WHEN len({smarks}) > 0 THEN 'Found some summary signals (' || {first(smarks, 3)} || '), but the section could be clearer.'
            ELSE 'No strong professional summary or objective section was detected.' END""",
        "experience": """CASE WHEN experience >= 8 THEN 'Detected ' || n_bullets || ' bullet markers, ' || n_impact || ' impact verbs, and about ' || years || ' years of experience.'
            ELSE 'Only ' || n_bullets || ' bullet markers and ' || n_impact || ' impact verbs were detected; measurable experience bullets would help.' END""",
        "education": f"""CASE WHEN len({degrees}) > 0 THEN 'Found education signals: ' || {first(degrees, 5)} || '.'
            ELSE 'No clear degree, school, college, university, or diploma signal was detected.' END""",
        "skills": f"""CASE WHEN len(skills) > 0 THEN 'Detected explicit skills such as ' || {first('skills', 6)} || '.'
            ELSE 'No canonical skill names from the current skill dictionary were detected.' END""",
        "keywords": f"""CASE WHEN len(keyword_marks) > 0 THEN 'Matched {LEX.system}-friendly terms: ' || {first('keyword_marks', 6)} || '.'
            ELSE 'Few general {LEX.system}-friendly keywords were found in the resume text.' END""",
        "consistency": "'Detected ' || n_bullets || ' bullet markers and ' || n_dates || ' date markers.'",
        "proofreading": f"""CASE WHEN len({typos}) > 0 THEN 'possible typos: ' || {first(typos, 4)}
            ELSE 'No common typo or spacing issues from the local checker were detected.' END""",
        "file_format": f"""upper(ext) || ' is ' || CASE WHEN ext IN ('pdf', 'docx') THEN 'a preferred {LEX.system} format'
            ELSE 'accepted but less formatting-stable than PDF or DOCX' END || '.'""",
        "relevance": f"""CASE WHEN target <> '' THEN 'Target role similarity is ' || {half_even('plain_similarity * 100')} || '% using weighted term overlap.'
            ELSE 'No target job description was supplied, so relevance used general resume completeness signals.' END""",
    }


REASONS = {key: compact(text) for key, text in _reasons().items()}

PARTS["k_reasons"] = "\nUNION ALL ".join(
    f"SELECT doc_id, {n} AS place, {q(label)} AS criterion, vals[{n}] AS score, {REASONS[key]} AS reason FROM k_scored"
    for n, (key, label) in enumerate(zip(L.CRITERION_KEYS, LEX.labels()), start=1)
)

PARTS["k_candidates"] = f"""
SELECT id AS doc_id, term, row_number() OVER (PARTITION BY id ORDER BY weight DESC, first_pos) AS place
FROM k_terms WHERE src = 'role' AND length(term) > 2 AND term NOT IN {names(LEX.low_signal_words)}
QUALIFY place <= 18
"""

ALIAS_ROWS = ", ".join(f"({q(name)}, {q(alias)})" for name, a in LEX.skills.items() for alias in a)
PARTS["k_presence"] = rf"""
SELECT c.doc_id, c.term, c.place,
       bool_or(regexp_matches(d.text, '(^|{FREE})' || regexp_escape(coalesce(a.alias, c.term)) || '($|{FREE})')) AS found
FROM k_candidates c JOIN k_docs d USING (doc_id)
LEFT JOIN (VALUES {ALIAS_ROWS}) AS a(skill, alias) ON a.skill = c.term
GROUP BY c.doc_id, c.term, c.place
"""

PARTS["k_target"] = f"""
SELECT d.doc_id, CASE WHEN coalesce(d.title, '') = '' THEN 'Target Role' ELSE d.title END AS title, coalesce(d.description, '') AS description,
       {clip("(s.role_similarity * 0.6::DOUBLE + (coalesce(p.n_found, 0)::DOUBLE / greatest(coalesce(p.n, 0), 1)) * 0.4::DOUBLE) * 100", 100)} AS match_score,
       coalesce(p.matched, [])[1:10] AS matched, coalesce(p.missing, [])[1:8] AS missing,
       coalesce(p.n_found, 0) AS n_found, coalesce(p.n, 0) AS n_candidates
FROM k_docs d JOIN k_similarity s USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n, count(*) FILTER (found) AS n_found,
                  coalesce(list(term ORDER BY place) FILTER (found), []) AS matched,
                  coalesce(list(term ORDER BY place) FILTER (NOT found), []) AS missing
           FROM k_presence GROUP BY doc_id) p USING (doc_id)
"""

PARTS["k_keyword_hits"] = """
SELECT d.doc_id, r.job_id, list_filter(r.keywords, lambda k: contains(d.text, k)) AS matched,
       list_filter(r.keywords, lambda k: NOT contains(d.text, k)) AS missing
FROM k_docs d CROSS JOIN k_roles r
"""

PARTS["k_dots"] = """
SELECT a.id AS doc_id, b.id AS job_id, CAST(sum(a.weight * b.weight) AS BIGINT) AS dot
FROM k_terms a JOIN k_terms b ON a.src = 'doc' AND b.src = 'job' AND a.term = b.term GROUP BY a.id, b.id
"""

PARTS["k_pairs"] = """
SELECT h.doc_id, h.job_id, h.matched, h.missing[1:5] AS missing, len(h.matched) AS n_matched,
       coalesce(x.dot / (sqrt(na.squared) * sqrt(nb.squared)), 0.0) AS similarity,
       (len(h.matched)::DOUBLE / greatest(len(h.matched) + len(h.missing), 1)) * 0.55::DOUBLE
         + coalesce(x.dot / (sqrt(na.squared) * sqrt(nb.squared)), 0.0) * 0.45::DOUBLE AS combined
FROM k_keyword_hits h
LEFT JOIN k_dots x ON x.doc_id = h.doc_id AND x.job_id = h.job_id
LEFT JOIN k_norms na ON na.src = 'doc' AND na.id = h.doc_id
LEFT JOIN k_norms nb ON nb.src = 'job' AND nb.id = h.job_id
"""

PARTS["k_kept"] = f"""
SELECT p.*, r.title, r.description, {clip('p.combined * 100', 100)} AS match_score
FROM k_pairs p JOIN k_roles r USING (job_id) WHERE p.combined >= 0.18 OR p.n_matched > 0
"""

PARTS["k_matches"] = """
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY is_target DESC, match_score DESC, job_id) AS rank,
       CASE WHEN is_target = 1 THEN 'target' ELSE 'catalog' END AS source, job_id, title, match_score, matched, missing
FROM (SELECT doc_id, 1 AS is_target, NULL::BIGINT AS job_id, title, match_score, matched, missing FROM k_target
      UNION ALL SELECT doc_id, 0, job_id, title, match_score, matched, missing FROM k_kept)
QUALIFY rank <= 5
"""

PARTS["k_missing"] = """
SELECT doc_id, keyword, count(*) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, min(rank * 1000 + pos)) AS place
FROM (SELECT doc_id, rank, unnest(missing) AS keyword, generate_subscripts(missing, 1) AS pos FROM k_matches WHERE rank <= 3)
GROUP BY doc_id, keyword QUALIFY place <= 5
"""

PARTS["k_lines"] = rf"""
SELECT doc_id, title, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM (
  SELECT doc_id, title, list_filter(list_transform(
      string_split_regex(raw_text, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]'),
      lambda l: {strip("ltrim(" + strip('l') + ", '-* •')")}), lambda l: length(l) >= 18) AS lines
  FROM k_docs)
"""

PARTS["k_weak"] = f"""
SELECT doc_id, title, line, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS place
FROM (SELECT *, {norm('line')} AS lowered FROM k_lines)
WHERE regexp_matches(lowered, '{alt(LEX.weak_verbs)}') OR NOT regexp_matches(lowered, '{METRIC}|delivered')
QUALIFY place <= 3
"""

PARTS["k_swapped"] = rf"""
SELECT doc_id, place, title, line, upper(substr(s, 1, 1)) || substr(s, 2) AS s
FROM (SELECT *, regexp_replace(line, '\b(?:{alt(L.REPLACED_PHRASES)})\b', 'Delivered', 'gi') AS s FROM k_weak)
"""

PARTS["k_finished"] = f"""
SELECT doc_id, place, line AS before, CASE WHEN regexp_matches({norm('s')}, '{METRIC}') THEN s
  ELSE 'Improved ' || lower(substr(s, 1, 1)) || substr(s, 2) || CASE WHEN coalesce(title, '') <> '' THEN ' for ' || title ELSE '' END
       || ', adding measurable outcomes such as time saved, quality gains, or user impact.' END AS finished
FROM k_swapped
"""
PARTS["k_rewrites"] = f"SELECT doc_id, place, before, {compact('finished', 240)} AS after FROM k_finished"

PARTS["k_matched_lists"] = """
SELECT doc_id, list({'rank': rank, 'title': title, 'source': source, 'score': match_score, 'missing': missing} ORDER BY rank) AS matches
FROM k_matches GROUP BY doc_id
"""

PARTS["k_advised"] = f"""
SELECT s.*, coalesce(m.matches, []) AS matches, coalesce(g.missing, []) AS top_missing
FROM k_scored s LEFT JOIN k_matched_lists m USING (doc_id)
LEFT JOIN (SELECT doc_id, list(keyword ORDER BY place) AS missing FROM k_missing GROUP BY doc_id) g USING (doc_id)
"""

TARGET_MISSING = "CASE WHEN len(matches) > 0 AND matches[1].source = 'target' THEN matches[1].missing ELSE [] END"
PARTS["k_suggestions"] = f"""
SELECT doc_id, (list_filter([
  CASE WHEN contact < 8 THEN 'Add a clear email/phone line and include LinkedIn or GitHub when relevant.' END,
  CASE WHEN summary < 7 THEN 'Add a 2-3 line professional summary tailored to the target role.' END,
  CASE WHEN experience < 7 THEN 'Rewrite experience bullets with impact: action verb + task + measurable outcome.' END,
  CASE WHEN skills_score < 8 AND len(top_missing) > 0 THEN 'Consider adding relevant skills from matching jobs: ' || array_to_string(top_missing, ', ') || '.'
       WHEN skills_score < 8 THEN 'Add a dedicated skills section with tools, methods, and soft skills.' END,
  CASE WHEN len(weak_verbs) > 0 THEN 'Replace weak phrasing like ' || array_to_string(weak_verbs[1:3], ', ') || ' with stronger action verbs.' END,
  CASE WHEN len(action_verbs) < 4 THEN 'Use more accomplishment verbs such as built, improved, automated, delivered, or optimized.' END,
  CASE WHEN word_count < 180 THEN 'The resume text is quite short; add project, role, education, and achievement detail.' END,
  CASE WHEN len(skills) = 0 THEN 'Add explicit skill names so {LEX.system} systems can match your profile reliably.' END,
  CASE WHEN len({TARGET_MISSING}) > 0 THEN 'Tailor this resume to the target role by adding evidence for: ' || array_to_string(({TARGET_MISSING})[1:5], ', ') || '.' END
], lambda x: x IS NOT NULL))[1:6] AS suggestions
FROM k_advised
"""

LABELS = lst(LEX.labels())
PARTS["k_steps"] = f"""
SELECT doc_id, 'Extracted ' || word_count || ' words and ' || len(skills) || ' skill signal(s).' AS parsed,
       'Strongest area: ' || ({LABELS})[list_position(vals, list_max(vals))] || '. Weakest area: '
         || ({LABELS})[list_position(vals, list_min(vals))] || '.' AS checked,
       'Compared resume terms with ' || CASE WHEN coalesce(title, '') <> '' THEN title WHEN len(matches) > 0 THEN matches[1].title
         ELSE 'the selected role' END || ' using role hints and weighted keyword overlap.' AS compared
FROM k_advised
"""


def compose(statement: str) -> str:
    """``statement`` with every sub-query it needs in front."""
    needed: list[str] = []
    seen: set[str] = set()

    def visit(sql: str) -> None:
        for name in sorted(set(re.findall(r"\bk_[a-z_]+\b", sql))):
            if name in PARTS and name not in seen:
                seen.add(name)
                visit(PARTS[name])
                needed.append(name)

    visit(statement)
    clauses = ",\n".join(f"{name} AS ({PARTS[name].strip()})" for name in needed)
    return f"WITH RECURSIVE {clauses}\n{statement.strip()}" if clauses else statement.strip()
