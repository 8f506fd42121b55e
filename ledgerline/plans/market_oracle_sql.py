"""DuckDB SQL twins of the market-side driver queries.

The stand-in inputs are rebuilt in SQL from the same tables; the rules are
re-expressed with DuckDB functions. DuckDB's regex engine (RE2) has no
look-around, so word boundaries are written as consuming alternatives
``(^|[^\\p{L}\\p{N}_])`` ... ``([^\\p{L}\\p{N}_]|$)``, which is equivalent for
match tests and for the first match's groups.
"""

from __future__ import annotations

import re

from ..functions import vocab
from . import standins

W = r"\p{L}\p{N}_"
PY_SPACE = r"[\t\n\v\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_list(options) -> str:
    return "[" + ", ".join("NULL::VARCHAR" if o is None else q(o) for o in options) + "]"


def pick(options, index_sql: str) -> str:
    return f"({sql_list(options)})[(({index_sql}) % {len(options)}) + 1]"


def re2_word(pattern: str) -> str:
    """A Python pattern with edge ``\\b`` -> RE2 with consuming boundaries."""
    out, i = [], 0
    while i < len(pattern):
        if pattern.startswith(r"\b", i):
            before = pattern[:i]
            start = not before or before[-1] in "(|"
            out.append(f"(^|[^{W}])" if start else f"([^{W}]|$)")
            i += 2
        elif pattern.startswith(r"\s", i):
            out.append(PY_SPACE)
            i += 2
        elif pattern.startswith(r"\d", i):
            out.append(r"\p{Nd}")
            i += 2
        elif pattern[i] == "\\":
            out.append(pattern[i:i + 2])
            i += 2
        else:
            out.append(pattern[i])
            i += 1
    return "".join(out)


def re2_any(patterns) -> str:
    return "|".join(f"(?:{re2_word(p)})" for p in patterns)


def pf(x: str) -> str:
    """Python float() of text."""
    return (
        f"(CASE WHEN ({x}) IS NULL OR ({x}) IN ('', 'null') "
        f"OR regexp_matches({x}, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?[dDfF]\\s*$') THEN NULL "
        f"ELSE TRY_CAST(regexp_replace({x}, '(\\d)_(\\d)', '\\1\\2', 'g') AS DOUBLE) END)"
    )


def raw_list(x: str) -> str:
    j = f"replace({x}, '''', '\"')"
    return f"(CASE WHEN json_valid({j}) AND json_type({j}) = 'ARRAY' THEN from_json({j}, '[\"VARCHAR\"]') END)"


def plist(x: str) -> str:
    """C11: list text -> list; unparsable or holding a null -> []."""
    lst = raw_list(x)
    return (
        f"(CASE WHEN {lst} IS NULL OR len(list_filter({lst}, lambda e: e IS NULL)) > 0 "
        f"THEN []::VARCHAR[] ELSE {lst} END)"
    )


def py_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{PY_SPACE}+|{PY_SPACE}+$', '', 'g')"


def nonempty_join(*parts: str) -> str:
    return "concat_ws(' ', " + ", ".join(f"nullif({p}, '')" for p in parts) + ")"


def iso_spelling(day: str, variant: str) -> str:
    d = f"strftime({day}, '%Y-%m-%d')"
    return (
        f"(CASE ({variant}) WHEN 0 THEN {d} || 'T12:00:00Z' WHEN 1 THEN {d} || ' 08:30:00+00' "
        f"WHEN 2 THEN {d} || 'T20:15:00-05:00' WHEN 3 THEN {d} WHEN 4 THEN 'junk' ELSE '' END)"
    )


def parse_iso(x: str) -> str:
    """C13 -> TIMESTAMP (UTC)."""
    c1 = f"regexp_replace({py_strip(x)}, 'Z$', '+00:00')"
    c2 = f"(CASE WHEN contains({c1}, ' ') AND NOT contains({c1}, 'T') THEN replace({c1}, ' ', 'T') ELSE {c1} END)"
    c3 = f"regexp_replace({c2}, '(\\+\\d{{2}})$', '\\1:00')"
    ok = f"regexp_full_match({c3}, '\\d{{4}}-\\d{{2}}-\\d{{2}}(T\\d{{2}}(:\\d{{2}}(:\\d{{2}}(\\.\\d{{1,6}})?)?)?([+-]\\d{{2}}:\\d{{2}})?)?')"
    # text without an offset is UTC, whatever the DuckDB session zone is
    c4 = (f"(CASE WHEN regexp_matches({c3}, '[+-]\\d{{2}}:\\d{{2}}$') THEN {c3} "
          f"WHEN length({c3}) = 10 THEN {c3} || 'T00:00:00+00:00' ELSE {c3} || '+00:00' END)")
    return f"(CASE WHEN {ok} THEN timezone('UTC', TRY_CAST({c4} AS TIMESTAMPTZ)) END)"


def normalize_tags(x: str) -> str:
    lst = f"from_json({x}, '[\"VARCHAR\"]')"
    return (
        f"(CASE WHEN {x} IS NULL THEN []::VARCHAR[] "
        f"WHEN starts_with({py_strip(x)}, '[') AND json_valid({x}) AND json_type({x}) = 'ARRAY' "
        f"THEN list_filter({lst}, lambda t: t IS NOT NULL) "
        f"ELSE list_filter(list_transform(string_split({x}, ','), lambda t: {py_strip('t')}), lambda t: t <> '') END)"
    )


_DAY = "(DATE '2021-01-01' + CAST(c.conv_id * 7 AS INTEGER))"

# flattened markets (standins.market_events + operators.markets.flatten_markets)
FLAT_MARKETS = f"""
ev AS (
  SELECT conv_id, arg_min(text, turn) AS first_text, arg_max(text, turn) AS last_text,
         arg_min(role, turn) AS first_role, COUNT(*) AS n_turns
  FROM conversations GROUP BY conv_id),
mk AS (
  SELECT c.conv_id, c.turn,
    CAST(c.conv_id AS VARCHAR) AS e_id,
    {pick(standins.MARKET_PHRASES, 'c.conv_id * 7')} || ' ' || e.first_text AS e_title,
    e.last_text AS e_description, NULL::VARCHAR AS e_ticker, 'conv-' || CAST(c.conv_id AS VARCHAR) AS e_slug,
    e.first_role AS e_category,
    {iso_spelling(_DAY + ' - 30', 'c.conv_id % 6')} AS e_start,
    {iso_spelling(_DAY, '(c.conv_id + 1) % 6')} AS e_end,
    {iso_spelling(_DAY + ' + 1', '(c.conv_id + 2) % 6')} AS e_closed,
    'event-src-' || CAST(c.conv_id AS VARCHAR) AS e_rs,
    CAST(e.n_turns * 10 AS VARCHAR) AS e_clob, '5' AS e_amm,
    CASE WHEN c.conv_id % 2 = 0 THEN '12.5' ELSE 'null' END AS e_oi,
    CAST(c.conv_id * 1000 + c.turn AS VARCHAR) AS m_id,
    {pick(standins.MARKET_PHRASES, 'c.conv_id + c.turn')} || ' ' || c.text AS m_question,
    CASE WHEN c.role = 'assistant' THEN '' WHEN c.role = 'system' THEN NULL ELSE c.text END AS m_description,
    {pick(standins.OUTCOME_TEXTS, 'c.turn')} AS m_outcomes,
    {pick(standins.PRICE_TEXTS, 'c.conv_id + c.turn')} AS m_prices,
    '["t' || CAST(c.conv_id AS VARCHAR) || '", "u' || CAST(c.turn AS VARCHAR) || '"]' AS m_clob,
    CASE WHEN c.turn % 3 = 0 THEN NULL WHEN c.turn % 3 = 1 THEN ''
         ELSE {iso_spelling("(DATE '2021-01-01' + CAST(c.conv_id * 7 + c.turn AS INTEGER))", 'c.turn % 4')} END AS m_closed,
    CASE WHEN c.role = 'user' THEN '' ELSE 'src-' || c.role END AS m_rs,
    CAST(length(c.text) AS VARCHAR) AS m_volume,
    CASE WHEN c.turn % 2 = 0 THEN 'null' ELSE CAST(c.turn * 1.5 AS VARCHAR) END AS m_v24,
    NULL::VARCHAR AS m_v1w,
    CAST(c.turn AS VARCHAR) || '_000' AS m_v1m,
    '1.0d' AS m_v1y,
    ' ' || CAST(c.turn + 1 AS VARCHAR) || ' ' AS m_liq,
    CASE WHEN c.turn % 3 = 0 THEN '0' ELSE CAST(c.turn AS VARCHAR) END AS m_amm
  FROM conversations c JOIN ev e ON c.conv_id = e.conv_id),
mk2 AS (
  SELECT *, {raw_list("m_outcomes")} AS o_list,
         list_transform({raw_list("m_prices")}, lambda p: {pf("p")}) AS p_list
  FROM mk),
fm AS (
  SELECT e_id AS event_id, m_id AS market_id, 'Polymarket' AS platform,
    coalesce(e_title, '') AS event_title, coalesce(m_question, '') AS market_question,
    e_category AS category, e_start AS start_date, e_end AS end_date,
    coalesce(nullif(m_closed, ''), e_closed) AS closed_time,
    {pf("m_volume")} AS total_volume, {pf("m_v24")} AS volume_24h, {pf("m_v1w")} AS volume_1w,
    {pf("m_v1m")} AS volume_1m, {pf("m_v1y")} AS volume_1y, {pf("m_liq")} AS liquidity,
    {pf("CASE WHEN m_amm IS NULL OR m_amm = '' OR TRY_CAST(m_amm AS DOUBLE) = 0 THEN e_amm ELSE m_amm END")} AS liquidity_amm,
    {pf("e_clob")} AS liquidity_clob, {pf("e_oi")} AS open_interest,
    len({plist("m_outcomes")}) AS num_outcomes, {plist("m_outcomes")} AS outcomes,
    CASE WHEN o_list IS NULL OR p_list IS NULL OR len(o_list) = 0 OR len(o_list) <> len(p_list)
              OR len(list_filter(p_list, lambda x: x IS NULL)) > 0
              OR len(list_filter(o_list, lambda x: x IS NULL)) > 0 THEN NULL
         ELSE o_list[list_filter(range(1, len(o_list) + 1), lambda i: p_list[i] >= 0.8 AND NOT isnan(p_list[i]))[1]]
    END AS winning_outcome,
    coalesce(nullif(m_rs, ''), e_rs) AS resolution_source,
    coalesce(nullif(m_description, ''), e_description) AS resolution_notes,
    {plist("m_clob")} AS clob_token_ids,
    e_description AS _event_description, e_ticker AS _event_ticker, e_slug AS _event_slug
  FROM mk2)"""

# latest analytics entry per market (standins.analytics_entries + latest_analytics)
ANALYTICS = f"""
ae AS (
  SELECT 'snapshot' AS _file, event_id AS _pos,
    CAST(user_id * 1000 + event_id % 8 AS VARCHAR) AS market_id,
    CAST(value AS VARCHAR) AS market_volume,
    json_extract_string(props, '$.k') AS market_open_interest,
    CAST(value / 100 AS VARCHAR) AS outcome_1_price, NULL::VARCHAR AS outcome_2_price,
    event_type AS event_slug, 'analytics' AS source,
    CASE event_type WHEN 'click' THEN {q(standins.TAG_TEXTS[0])} WHEN 'view' THEN {q(standins.TAG_TEXTS[1])}
                    WHEN 'error' THEN {q(standins.TAG_TEXTS[2])} WHEN 'signup' THEN {q(standins.TAG_TEXTS[5])} END AS event_tags,
    strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS market_close_date, NULL::VARCHAR AS event_end_date,
    CASE WHEN event_type = 'purchase' THEN 'Ohio senate special' END AS event_title,
    NULL::VARCHAR AS event_description
  FROM events),
la AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY market_id ORDER BY _file DESC, _pos DESC) AS rn
    FROM ae WHERE market_id IS NOT NULL) WHERE rn = 1),
lac AS (
  SELECT market_id AS a_market_id,
    {pf("market_volume")} AS analytics_market_volume, {pf("market_open_interest")} AS analytics_market_open_interest,
    {pf("outcome_1_price")} AS analytics_outcome_yes_price, {pf("outcome_2_price")} AS analytics_outcome_no_price,
    event_slug AS analytics_event_slug, source AS analytics_source,
    {normalize_tags("event_tags")} AS analytics_event_tags,
    market_close_date AS a_market_close_date, event_end_date AS a_event_end_date,
    event_title AS a_event_title, event_description AS a_event_description
  FROM la)"""

_TAGS_SQL = "(" + ", ".join(q(t) for t in vocab.ELECTION_TAGS) + ")"
ENRICHED = f"""
em AS (
  SELECT fm.*, lac.* EXCLUDE (a_market_id, analytics_event_tags),
         coalesce(lac.analytics_event_tags, []::VARCHAR[]) AS analytics_event_tags
  FROM fm LEFT JOIN lac ON fm.market_id = lac.a_market_id)"""


def office_case(text: str) -> str:
    low = f"lower({text})"
    whens = []
    for office, patterns in vocab.OFFICE_PATTERNS:
        cond = f"regexp_matches({low}, {q(re2_any(patterns))})"
        if office == "House":
            cond += f" AND NOT contains({low}, {q(vocab.HOUSE_EXCEPTION_PHRASE)})"
        whens.append(f"WHEN {cond} THEN {q(office)}")
    return f"(CASE WHEN {text} IS NULL OR {text} = '' THEN NULL " + " ".join(whens) + " END)"


_ABBR_CASE = "CASE {x} " + " ".join(f"WHEN {q(a)} THEN {q(n)}" for a, n in vocab.US_DIVISIONS) + " END"


def jurisdiction_case(text: str) -> str:
    """C19 + C20 as (name, level) CASE pairs over ``text``."""
    low = f"lower({text})"
    name_hits = []
    for _, name in vocab.US_DIVISIONS:
        pat = f"(^|[^{W}]){re.escape(name.lower()).replace(chr(92) + ' ', ' ')}([^{W}]|$)"
        name_hits.append((f"regexp_matches({low}, {q(pat)})", name))
    district = f"nullif(regexp_extract({text}, {q(f'(^|[^{W}])([A-Z]{{2}})[-– ]?(\\p{{Nd}}{{1,2}})([^{W}]|$)')}, 2), '')"
    senate = (f"upper(nullif(regexp_extract({text}, "
              f"{q(f'(?i)(^|[^{W}])([a-z]{{2}})[^{W}\\n]([^\\n]*[^{W}\\n])?senate([^{W}]|$)')}, 2), ''))")
    governor = (f"upper(nullif(regexp_extract({text}, "
                f"{q(f'(?i)(^|[^{W}])([a-z]{{2}})[^{W}\\n]([^\\n]*[^{W}\\n])?governor')}, 2), ''))")
    d_state = _ABBR_CASE.format(x=district)
    s_state = _ABBR_CASE.format(x=senate)
    g_state = _ABBR_CASE.format(x=governor)
    name_w, level_w = [], []
    for cond, name in name_hits:
        name_w.append(f"WHEN {cond} THEN {q(name)}")
        level_w.append(f"WHEN {cond} THEN 'state'")
    for expr, lvl in ((d_state, "district"), (s_state, "state"), (g_state, "state")):
        name_w.append(f"WHEN ({expr}) IS NOT NULL THEN ({expr})")
        level_w.append(f"WHEN ({expr}) IS NOT NULL THEN {q(lvl)}")
    for kw, name, lvl in vocab.COUNTRY_KEYWORDS:
        name_w.append(f"WHEN contains({low}, {q(kw)}) THEN {q(name)}")
        level_w.append(f"WHEN contains({low}, {q(kw)}) THEN {q(lvl)}")
    tail = [
        (f"contains({low}, 'mayor') AND contains({low}, 'london')", "United Kingdom - London", "city"),
        (f"contains({low}, 'mayor') AND contains({low}, 'new york')", "United States - New York City", "city"),
        (f"contains({low}, 'senate') OR contains({low}, 'house') OR contains({low}, 'congress')", "United States", "national"),
        (f"contains({low}, 'parliament')", "European Union", "supra-national"),
    ]
    for cond, name, lvl in tail:
        name_w.append(f"WHEN {cond} THEN {q(name)}")
        level_w.append(f"WHEN {cond} THEN {q(lvl)}")
    empty = f"WHEN {text} IS NULL OR {text} = '' THEN "
    name_sql = f"(CASE {empty}'Unclassified' " + " ".join(name_w) + " ELSE 'Unclassified' END)"
    level_sql = f"(CASE {empty}'unknown' " + " ".join(level_w) + " ELSE 'unknown' END)"
    return name_sql, level_sql


_JTEXT = nonempty_join("event_title", "market_question", "category", "resolution_notes", "a_event_title", "a_event_description")
_J_NAME, _J_LEVEL = jurisdiction_case(_JTEXT)
TAGGED = f"""
tg AS (SELECT *, {_J_NAME} AS jurisdiction, {_J_LEVEL} AS jurisdiction_level FROM em)"""


def _source_row(jur_sql: str, level_sql: str, pos: int, fields) -> str:
    vals = ", ".join(f if f.startswith("(") else q(f) for f in fields)
    return f"SELECT {jur_sql} AS jurisdiction, {level_sql} AS level, {pos} AS pos, {vals}"


def _fill(template_value, name_sql: str) -> str:
    if template_value is None:
        return None
    parts = re.split(r"(\{name\}|\{slug\})", template_value)
    out = []
    for p in parts:
        if p == "{name}":
            out.append(name_sql)
        elif p == "{slug}":
            out.append(f"replace({name_sql}, ' ', '_')")
        elif p:
            out.append(q(p))
    return "(" + " || ".join(out) + ")" if out else "''"


def catalog_sql() -> str:
    """Catalog (C21-C24, A8, A9) from the tagged markets ``tg``."""
    lib_rows = []
    for i, row in enumerate(vocab.COUNTRY_SOURCE_LIBRARY):
        lib_rows.append("(" + ", ".join(q(v) for v in row) + f", {i})")
    lib_values = ",\n    ".join(lib_rows)
    sites = ",\n    ".join(f"({q(n)}, {q(u)})" for n, u in vocab.STATE_OFFICIAL_SITES)
    states = ", ".join(q(n) for n in sorted({n for _, n in vocab.US_DIVISIONS} | {n for n, _ in vocab.STATE_OFFICIAL_SITES}))
    cols = "name, url, description, access, update_frequency, feasibility, feasibility_notes"

    def tmpl(t, name_sql, url_sql=None):
        vals = []
        for v in t:
            vals.append(url_sql if v is None else _fill(v, name_sql))
        return ", ".join(vals)

    st = "s_name"
    return f"""
lib(jurisdiction, level, name, url, description, access, update_frequency, feasibility, feasibility_notes, pos) AS (
  VALUES {lib_values}),
sites(state, url) AS (VALUES {sites}),
firstlvl AS (SELECT jurisdiction, arg_min(jurisdiction_level, (TRY_CAST(market_id AS HUGEINT) IS NULL, coalesce(TRY_CAST(market_id AS HUGEINT), 0), market_id, jurisdiction_level)) AS lvl FROM tg GROUP BY jurisdiction),
kinds AS (
  SELECT jurisdiction, lvl,
    CASE WHEN jurisdiction IN (SELECT jurisdiction FROM lib) THEN 'lib'
         WHEN jurisdiction IN ({states}) THEN 'state'
         WHEN starts_with(jurisdiction, 'United States -') THEN 'usx'
         ELSE 'generic' END AS kind,
    CASE WHEN starts_with(jurisdiction, 'United States -') AND jurisdiction NOT IN ({states})
              AND jurisdiction NOT IN (SELECT jurisdiction FROM lib)
         THEN trim(regexp_extract(jurisdiction, '(?s)^[^-]*-(.*)$', 1)) ELSE jurisdiction END AS s_name
  FROM firstlvl),
srcs AS (
  SELECT k.jurisdiction, l.level, l.pos, {", ".join("l." + c for c in cols.split(", "))}
  FROM kinds k JOIN lib l ON k.jurisdiction = l.jurisdiction WHERE k.kind = 'lib'
  UNION ALL
  SELECT k.jurisdiction, CASE WHEN k.kind = 'usx' THEN (CASE WHEN contains(k.jurisdiction, 'City') THEN 'city' ELSE 'state' END) ELSE k.lvl END,
         0, {tmpl(vocab.STATE_OFFICE_SOURCE, 'k.s_name', 's.url')}
  FROM kinds k JOIN sites s ON k.s_name = s.state WHERE k.kind IN ('state', 'usx')
  UNION ALL
  SELECT k.jurisdiction, CASE WHEN k.kind = 'usx' THEN (CASE WHEN contains(k.jurisdiction, 'City') THEN 'city' ELSE 'state' END) ELSE k.lvl END,
         0, {tmpl(vocab.STATE_DIRECTORY_SOURCE, 'k.s_name')}
  FROM kinds k WHERE k.kind IN ('state', 'usx') AND k.s_name NOT IN (SELECT state FROM sites)
  UNION ALL
  SELECT k.jurisdiction, CASE WHEN k.kind = 'usx' THEN (CASE WHEN contains(k.jurisdiction, 'City') THEN 'city' ELSE 'state' END) ELSE k.lvl END,
         1, {tmpl(vocab.STATE_ENCYCLOPEDIA_SOURCE, 'k.s_name')}
  FROM kinds k WHERE k.kind IN ('state', 'usx')
  UNION ALL
  SELECT k.jurisdiction, CASE WHEN k.kind = 'usx' THEN (CASE WHEN contains(k.jurisdiction, 'City') THEN 'city' ELSE 'state' END) ELSE k.lvl END,
         2, {tmpl(vocab.STATE_RESULTS_FEED_SOURCE, 'k.s_name')}
  FROM kinds k WHERE k.kind IN ('state', 'usx')
  UNION ALL
  SELECT k.jurisdiction, k.lvl, 0, {tmpl(vocab.GENERIC_WIRE_SOURCE, 'k.jurisdiction')}
  FROM kinds k WHERE k.kind = 'generic'
  UNION ALL
  SELECT k.jurisdiction, k.lvl, 1, {tmpl(vocab.GENERIC_LOCAL_SOURCE, 'k.jurisdiction')}
  FROM kinds k WHERE k.kind = 'generic'),
best AS (
  SELECT jurisdiction, arg_min(feasibility, (-score, pos)) AS jurisdiction_feasibility,
         arg_min(feasibility_notes, (-score, pos)) AS jurisdiction_feasibility_notes
  FROM (SELECT *, CASE feasibility WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 ELSE 0 END AS score FROM srcs)
  GROUP BY jurisdiction)"""


SQL = {}

SQL["market_flatten"] = f"""
WITH {FLAT_MARKETS}
SELECT * EXCLUDE (_event_description, _event_ticker, _event_slug, outcomes, clob_token_ids),
       to_json(outcomes) AS outcomes, to_json(clob_token_ids) AS clob_token_ids FROM fm
"""

SQL["analytics_latest"] = f"""
WITH {ANALYTICS}
SELECT a_market_id AS market_id, analytics_market_volume, analytics_market_open_interest,
       analytics_outcome_yes_price, analytics_outcome_no_price, analytics_event_slug, analytics_source,
       to_json(analytics_event_tags) AS analytics_event_tags, a_market_close_date AS market_close_date
FROM lac
"""

SQL["tag_gate"] = f"""
WITH {FLAT_MARKETS}, {ANALYTICS}
SELECT event_id, market_id FROM fm
WHERE market_id IN (
  SELECT a_market_id FROM lac
  WHERE list_has_any(list_transform(list_filter(analytics_event_tags, lambda t: t IS NOT NULL AND t <> ''),
                                    lambda t: lower(trim(t))), [{", ".join(q(t) for t in vocab.ELECTION_TAGS)}]))
"""

_F3 = " OR ".join(
    f"contains(lower({nonempty_join('event_title', '_event_description', '_event_ticker', '_event_slug', 'category')}), {q(w)})"
    for w in vocab.ELECTION_KEYWORDS
)
SQL["election_text_filter"] = f"""
WITH {FLAT_MARKETS}
SELECT event_id, market_id FROM fm
WHERE ({_F3}) AND coalesce(regexp_matches(market_question, {q("(?i)" + re2_any(vocab.QUESTION_PATTERNS))}), false)
"""

_CLOSED = "coalesce(" + ", ".join(
    parse_iso(c) for c in ("closed_time", "end_date", "start_date", "a_market_close_date", "a_event_end_date")
) + ")"
SQL["closed_time_recent"] = f"""
WITH {FLAT_MARKETS}, {ANALYTICS}, {ENRICHED},
r AS (SELECT market_id, closed_time, {_CLOSED} AS closed_ts FROM em)
SELECT market_id,
       CASE WHEN coalesce(closed_time, '') = '' THEN strftime(closed_ts, '%Y-%m-%dT%H:%M:%S')
            || CASE WHEN epoch_us(closed_ts) % 1000000 <> 0 THEN '.' || lpad(CAST(epoch_us(closed_ts) % 1000000 AS VARCHAR), 6, '0') ELSE '' END
            || '+00:00' ELSE closed_time END AS closed_time,
       closed_ts
FROM r WHERE closed_ts >= TIMESTAMP '2024-01-01 00:00:00' - INTERVAL 730 DAYS
"""

_OTEXT = nonempty_join("event_title", "market_question", "category", "resolution_notes",
                       "array_to_string(analytics_event_tags, ' ')")
SQL["office_inference"] = f"""
WITH {FLAT_MARKETS}, {ANALYTICS}, {ENRICHED}
SELECT market_id, {office_case(_OTEXT)} AS office FROM em
"""

SQL["jurisdiction_inference"] = f"""
WITH {FLAT_MARKETS}, {ANALYTICS}, {ENRICHED}, {TAGGED}
SELECT market_id, jurisdiction, jurisdiction_level FROM tg
"""

SQL["source_catalog"] = f"""
WITH {FLAT_MARKETS}, {ANALYTICS}, {ENRICHED}, {TAGGED}, {catalog_sql()}
SELECT s.jurisdiction, s.level, s.name AS source_name, s.url, s.description, s.access, s.update_frequency,
       s.feasibility, s.feasibility_notes, b.jurisdiction_feasibility, b.jurisdiction_feasibility_notes
FROM srcs s JOIN best b ON s.jurisdiction = b.jurisdiction
"""

# what the catalogue files hold (see roundtrip_queries)
SQL["catalog_sources"] = f"""
WITH {FLAT_MARKETS}, {ANALYTICS}, {ENRICHED}, {TAGGED}, {catalog_sql()}
SELECT jurisdiction, level, name AS source_name, url, description, access, update_frequency, feasibility, feasibility_notes, level AS json_level,
       CAST(row_number() OVER (PARTITION BY jurisdiction ORDER BY pos) - 1 AS INTEGER) AS source_at, feasibility AS json_feasibility
FROM srcs
"""

# --- names and linkage --------------------------------------------------------

CAP_RUN = r"\b[A-Z][A-Za-z'.-]*(?: +[A-Z][A-Za-z'.-]*)*"
NAME_TOKEN = vocab.NAME_TOKEN_PATTERN
_EDGE = "[" + re.escape(vocab.NAME_EDGE_CHARACTERS) + "]"


def capwords(x: str) -> str:
    words = f"list_filter(regexp_split_to_array({x}, '{PY_SPACE}+'), lambda w: w <> '')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || lower(w[2:])), ' ')"


def first_spelling(lst: str) -> str:
    return (f"list_filter({lst}, lambda x, i: NOT list_contains("
            f"list_transform({lst}[1:i - 1], lambda y: lower(y)), lower(x)))")


_SUFFIXES = ", ".join(q(t) for t in vocab.PERSON_SUFFIX_TOKENS)
_EXCLUDED = ", ".join(q(t) for t in vocab.PERSON_EXCLUSION_TOKENS)

# The alphabetic words of a text, those that decide on its capitalised form
_ALPHABETIC = (r"list_filter(regexp_extract_all(regexp_replace(t, '\.\s*$', ''), '[^\s,;:@#$%&?!\"()\[\]{}<>''`]+'), "
               r"lambda w: regexp_full_match(w, '\p{L}+'))")

def names_sql(persons: str) -> str:
    """C9 with the persons of a query (column ``name``): all of them in one
    alternation, written without the library's word rules. Non-letters are
    doubled, so that names side by side each find a border."""
    return f"""
persons AS (SELECT '(?i)(?:^|[^\\p{{L}}])(' || coalesce(string_agg(DISTINCT replace(name, ' ', '\\s+'), '|'), 'no persons') || ')(?:$|[^\\p{{L}}])' AS pattern FROM ({persons})),
nm1 AS (
  SELECT market_id,
    list_filter(list_concat(analytics_event_tags, [resolution_notes]), lambda t: t IS NOT NULL AND t <> '') AS kept
  FROM em),
nm2 AS (
  SELECT market_id, flatten(list_transform(kept, lambda t:
      CASE WHEN len({_ALPHABETIC}) > 0 AND len(list_filter({_ALPHABETIC}, lambda w: NOT (w = lower(w) AND w <> upper(w)))) = 0
        AND {capwords('t')} <> t THEN [t, {capwords('t')}] ELSE [t] END)) AS variants
  FROM nm1),
nm3 AS (
  SELECT market_id, flatten(list_transform(variants, lambda v: CASE WHEN regexp_matches(v, pattern) THEN regexp_extract_all(regexp_replace(v, '([^\\p{{L}}])', '\\1\\1', 'g'), pattern, 1)
    ELSE regexp_extract_all(v, {q(CAP_RUN)}, 0) END)) AS spans
  FROM nm2, persons),
nm4 AS (
  SELECT market_id, list_filter(list_transform(spans, lambda s:
      regexp_replace(trim(regexp_replace(s, '{PY_SPACE}+', ' ', 'g')), {q('^' + _EDGE + '+|' + _EDGE + '+$')}, '', 'g')),
      lambda s: s <> '') AS cleaned
  FROM nm3),
nm5 AS (
  SELECT market_id, list_filter(cleaned, lambda s:
      len(list_filter(list_transform(regexp_extract_all(s, {q(NAME_TOKEN)}, 0), lambda t: lower(t)),
                      lambda t: t NOT IN ({_SUFFIXES}))) > 0
      AND NOT list_has_any(list_filter(list_transform(regexp_extract_all(s, {q(NAME_TOKEN)}, 0), lambda t: lower(t)),
                                       lambda t: t NOT IN ({_SUFFIXES})), [{_EXCLUDED}])) AS plausible
  FROM nm4),
nm6 AS (SELECT market_id, {first_spelling('plausible')} AS deduped FROM nm5),
nm7 AS (
  SELECT market_id, list_transform(deduped, lambda n: {{'n': n, 't': regexp_extract_all(n, {q(NAME_TOKEN)}, 0)}}) AS tk
  FROM nm6),
nm8 AS (
  SELECT market_id, tk,
    list_transform(flatten(list_transform(list_filter(tk, lambda e: len(e.t) > 1), lambda e: e.t)), lambda t: lower(t)) AS multi
  FROM nm7),
names AS (
  SELECT market_id,
    list_transform(list_filter(tk, lambda e: NOT (len(e.t) = 1 AND list_contains(multi, lower(e.t[1])))), lambda e: e.n)
      AS candidate_names
  FROM nm8)"""


NAMES = names_sql("SELECT NULL AS name WHERE false")

SQL["name_candidates"] = f"""
WITH {FLAT_MARKETS}, {ANALYTICS}, {ENRICHED},
{names_sql(r"SELECT lower(regexp_extract(text, '^(\p{L}+ \p{L}+)', 1)) AS name FROM conversations WHERE turn % 2 = 0 AND regexp_matches(text, '^\p{L}+ \p{L}+')")}
SELECT market_id, to_json(candidate_names) AS candidate_names FROM names
"""


def _initcap_word(x: str) -> str:
    return f"(upper({x}[1]) || lower({x}[2:]))"


def safe_int_sql(x: str) -> str:
    s = py_strip(f"CAST({x} AS VARCHAR)")
    return f"(CASE WHEN regexp_full_match({s}, '[+-]?\\d+') THEN TRY_CAST({s} AS INTEGER) END)"


def _link_sql() -> str:
    from .oracle_sql import _PART_MASTER, candidate_dim_ctes

    w1, w2 = "split_part(p_name, ' ', 1)", "split_part(p_name, ' ', 2)"
    names = (
        f"CASE smin % 4 WHEN 0 THEN {_initcap_word(w1)} || ' ' || {_initcap_word(w2)} "
        f"WHEN 1 THEN {_initcap_word(w1)} || ' ' || {_initcap_word(w2)} || ', ' || {_initcap_word(w2)} || ' ' || {_initcap_word(w1)} "
        f"WHEN 2 THEN upper({w2}) || ' | ' || {_initcap_word(w1)} || ' ' || {_initcap_word(w2)} ELSE 'nan' END"
    )
    text = py_strip("candidate_names")
    parts = f"list_filter(list_transform(regexp_split_to_array({text}, '[|,]'), lambda x: {py_strip('x')}), lambda x: x <> '')"
    words = f"list_filter(regexp_split_to_array(replace(query, ',', ' '), '{PY_SPACE}+'), lambda w: w <> '')"
    return f"""
WITH {candidate_dim_ctes(_PART_MASTER, "pdim", "pp")},
mkt AS (
  SELECT p_name AS market_id, {names} AS candidate_names,
    (['President', 'senate', 'House', 'Governor', NULL::VARCHAR])[smax % 5 + 1] AS office,
    CASE WHEN smin % 3 = 0 THEN NULL ELSE CAST(1994 + (smin % 3) * 2 AS VARCHAR) || '-01-01' END AS start_date,
    CASE WHEN smax % 4 = 0 THEN NULL ELSE CAST(1996 + (smax % 3) * 2 AS VARCHAR) || '-12-31' END AS end_date
  FROM (SELECT p_name, min(p_size) AS smin, max(p_size) AS smax FROM part GROUP BY p_name)),
mq AS (
  SELECT *, CASE WHEN {text} IS NULL OR {text} = '' OR lower({text}) IN ('nan', 'none', 'null') THEN []::VARCHAR[]
                 ELSE list_concat([{text}], {parts}) END AS ordered
  FROM mkt),
mq2 AS (SELECT market_id, office, start_date, end_date, unnest({first_spelling('ordered')}) AS query FROM mq),
mq3 AS (
  SELECT *, CASE WHEN len({words}) = 0 THEN '%' ELSE '%' || array_to_string({words}, '%') || '%' END AS pattern
  FROM mq2),
mq4 AS (
  SELECT * FROM mq3
  WHERE len(list_filter(flatten(list_transform(string_split(pattern, '%'), lambda s: string_split(s, '_'))),
                        lambda r: length(r) > 0 AND NOT contains(r, '\\'))) > 0),
cands AS (
  SELECT cand_id, search_text, {safe_int_sql('cycle')} AS c_cycle,
    coalesce(nullif({safe_int_sql('candidate_election_year')}, 0), {safe_int_sql('cycle')}) AS eyear,
    lower(trim(office_full)) AS ofull, lower(trim(office)) AS ocode,
    coalesce(nullif(normalized_name, ''), display_name) AS matched_candidate_name
  FROM pdim WHERE cand_id IS NOT NULL AND CAST(cand_id AS VARCHAR) <> ''),
pairs AS (
  SELECT m.market_id, c.cand_id, c.c_cycle, c.matched_candidate_name, c.eyear, c.ofull, c.ocode,
         year(TRY_CAST({py_strip('m.start_date')} AS TIMESTAMP)) AS sy,
         year(TRY_CAST({py_strip('m.end_date')} AS TIMESTAMP)) AS ey,
         lower(m.office) AS wanted
  FROM mq4 m JOIN cands c ON c.search_text ILIKE m.pattern),
kept AS (
  SELECT DISTINCT market_id, cand_id, c_cycle, matched_candidate_name FROM pairs
  WHERE (sy IS NULL OR eyear IS NULL OR eyear >= sy) AND (ey IS NULL OR eyear IS NULL OR eyear <= ey)
    AND (NOT coalesce(wanted IN ('president', 'senate', 'house'), false)
         OR coalesce(nullif(ofull, ''), ocode, '') = wanted
         OR coalesce(nullif(ofull, ''), ocode, '') = (CASE wanted WHEN 'president' THEN 'p' WHEN 'senate' THEN 's' WHEN 'house' THEN 'h' END)))
SELECT m.market_id, m.candidate_names, m.office, m.start_date, m.end_date,
       k.cand_id AS matched_candidate_id, k.matched_candidate_name
FROM mkt m LEFT JOIN kept k ON m.market_id = k.market_id
"""


SQL["market_links"] = _link_sql()

# --- the whole market dataset job ---------------------------------------------------

_GATE = (f"market_id IN (SELECT a_market_id FROM lac WHERE list_has_any(list_transform(list_filter("
         f"analytics_event_tags, lambda t: t IS NOT NULL AND t <> ''), lambda t: lower(trim(t))), "
         f"[{', '.join(q(t) for t in vocab.ELECTION_TAGS)}]))")

SQL["market_dataset"] = f"""
WITH {FLAT_MARKETS}, {ANALYTICS}, {ENRICHED}, {NAMES},
rc AS (
  SELECT em.*, {_CLOSED} AS closed_ts FROM em WHERE {_GATE}),
rc2 AS (
  SELECT * REPLACE (
    CASE WHEN coalesce(closed_time, '') = '' THEN strftime(closed_ts, '%Y-%m-%dT%H:%M:%S')
         || CASE WHEN epoch_us(closed_ts) % 1000000 <> 0 THEN '.' || lpad(CAST(epoch_us(closed_ts) % 1000000 AS VARCHAR), 6, '0') ELSE '' END
         || '+00:00' ELSE closed_time END AS closed_time)
  FROM rc WHERE closed_ts >= TIMESTAMP '2024-01-01 00:00:00' - INTERVAL 730 DAYS),
tg AS (SELECT *, {_J_NAME} AS jurisdiction, {_J_LEVEL} AS jurisdiction_level FROM rc2),
{catalog_sql()},
srcnames AS (SELECT jurisdiction, list(name ORDER BY pos) AS jurisdiction_sources FROM srcs GROUP BY jurisdiction)
SELECT t.event_id, t.market_id, t.platform, t.event_title, t.market_question, t.jurisdiction, t.jurisdiction_level,
       to_json(s.jurisdiction_sources) AS jurisdiction_sources, b.jurisdiction_feasibility, t.category, t.start_date, t.end_date, t.closed_time,
       t.total_volume, t.volume_24h, t.volume_1w, t.volume_1m, t.volume_1y, t.liquidity, t.liquidity_amm,
       t.liquidity_clob, t.open_interest, t.num_outcomes, to_json(t.outcomes) AS outcomes, t.winning_outcome,
       t.resolution_source, t.resolution_notes, to_json(t.clob_token_ids) AS clob_token_ids,
       t.analytics_market_volume, t.analytics_market_open_interest,
       t.analytics_outcome_yes_price, t.analytics_outcome_no_price, t.analytics_event_slug, t.analytics_source,
       to_json(t.analytics_event_tags) AS analytics_event_tags, to_json(n.candidate_names) AS candidate_names, {office_case(_OTEXT.replace('analytics_event_tags', 't.analytics_event_tags').replace('event_title', 't.event_title').replace('market_question', 't.market_question').replace('category', 't.category').replace('resolution_notes', 't.resolution_notes'))} AS office
FROM tg t
LEFT JOIN srcnames s ON t.jurisdiction = s.jurisdiction
LEFT JOIN best b ON t.jurisdiction = b.jurisdiction
LEFT JOIN names n ON t.market_id = n.market_id
"""

SQL["winning_outcome"] = f"""
WITH t AS (
  SELECT event_id,
    CASE event_type WHEN 'click' THEN '["Yes","No"]' WHEN 'view' THEN '[''Up'',''Down'']'
         WHEN 'error' THEN '["A","B","C"]' WHEN 'signup' THEN '[]' ELSE 'oops' END AS outcomes_text,
    '["' || CAST(floor(value) / 100 AS VARCHAR) || '","' || CAST((100 - floor(value)) / 100 AS VARCHAR) || '"]' AS prices_text
  FROM events),
t2 AS (SELECT *, {raw_list("outcomes_text")} AS o_list,
              list_transform({raw_list("prices_text")}, lambda p: {pf("p")}) AS p_list FROM t)
SELECT event_id, outcomes_text, prices_text, to_json({plist("outcomes_text")}) AS outcomes,
       len({plist("outcomes_text")}) AS num_outcomes,
       CASE WHEN o_list IS NULL OR p_list IS NULL OR len(o_list) = 0 OR len(o_list) <> len(p_list)
                 OR len(list_filter(p_list, lambda x: x IS NULL)) > 0
                 OR len(list_filter(o_list, lambda x: x IS NULL)) > 0 THEN NULL
            ELSE o_list[list_filter(range(1, len(o_list) + 1), lambda i: p_list[i] >= 0.8 AND NOT isnan(p_list[i]))[1]]
       END AS winning_outcome
FROM t2
"""

SQL["catalog_json"] = f"""
WITH {FLAT_MARKETS}, {ANALYTICS}, {ENRICHED}, {TAGGED}, {catalog_sql()}
SELECT s.jurisdiction,
       to_json({{'level': min(s.level),
                'sources': list({{'name': s.name, 'url': s.url, 'description': s.description, 'access': s.access,
                                 'update_frequency': s.update_frequency, 'feasibility': s.feasibility,
                                 'feasibility_notes': s.feasibility_notes}} ORDER BY s.pos)}}) AS entry
FROM srcs s GROUP BY s.jurisdiction
"""
