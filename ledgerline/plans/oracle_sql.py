"""DuckDB SQL twins of the driver queries (same keys, same column names).

Conventions shared with the Spark side: money is summed as DECIMAL and cast
to DOUBLE, integer outputs are cast explicitly, NULL ordering is spelled out.
"""

from __future__ import annotations

# receipts stand-in: lineitem joined to orders (see standins.receipts)
_RECEIPTS = """
  SELECT o.o_custkey AS candidate_id,
         l.l_suppkey AS committee_id,
         CAST(year(o.o_orderdate) + year(o.o_orderdate) % 2 AS INTEGER) AS two_year_transaction_period,
         CAST(year(l.l_shipdate) AS INTEGER) AS report_year,
         l.l_linestatus AS report_type,
         CAST(l.l_partkey AS VARCHAR) AS contributor_name,
         CASE l.l_returnflag WHEN 'A' THEN 'IND' WHEN 'R' THEN 'COM' WHEN 'N' THEN 'PTY' END AS entity_type,
         l.l_extendedprice AS contribution_receipt_amount,
         strftime(l.l_shipdate, '%Y-%m-%d') AS contribution_receipt_date,
         l.l_orderkey AS l_orderkey,
         c.c_nationkey AS nationkey
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
"""

SQL = {}

SQL["candidate_cycle_summary"] = f"""
WITH r AS ({_RECEIPTS})
SELECT candidate_id,
       two_year_transaction_period AS cycle,
       CAST(SUM(CAST(contribution_receipt_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_receipts,
       CAST(SUM(CASE WHEN entity_type = 'IND' THEN CAST(contribution_receipt_amount AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS individual_receipts,
       CAST(SUM(CASE WHEN entity_type IN ('CCM','COM') THEN CAST(contribution_receipt_amount AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS committee_receipts,
       CAST(SUM(CASE WHEN entity_type = 'PTY' THEN CAST(contribution_receipt_amount AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS party_receipts,
       COUNT(*) AS transaction_count
FROM r
WHERE candidate_id IS NOT NULL
GROUP BY candidate_id, two_year_transaction_period
"""

SQL["candidate_committee_details"] = f"""
WITH r AS ({_RECEIPTS})
SELECT candidate_id, committee_id, two_year_transaction_period AS cycle, report_year, report_type,
       CAST(SUM(CAST(contribution_receipt_amount AS DECIMAL(18,2))) AS DOUBLE) AS receipts,
       COUNT(*) AS transactions
FROM r
WHERE candidate_id IS NOT NULL
GROUP BY candidate_id, committee_id, two_year_transaction_period, report_year, report_type
"""

SQL["top_contributors"] = f"""
WITH r AS ({_RECEIPTS}),
t AS (
  SELECT CAST(nationkey AS BIGINT) AS candidate_id, two_year_transaction_period AS cycle,
         contributor_name, entity_type,
         CAST(SUM(CAST(contribution_receipt_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
  FROM r WHERE nationkey IS NOT NULL
  GROUP BY 1, 2, 3, 4
)
SELECT candidate_id, cycle, contributor_name, entity_type, total_amount
FROM (
  SELECT *, row_number() OVER (PARTITION BY candidate_id, cycle
                               ORDER BY total_amount DESC NULLS LAST,
                                        contributor_name ASC NULLS LAST,
                                        entity_type ASC NULLS LAST) AS rk
  FROM t
) WHERE rk <= 20
"""

# --- dimensions and flat receipts -------------------------------------------

_CANDIDATE_MASTER = """
  SELECT o.o_orderkey, o.o_custkey AS CAND_ID,
         CAST(year(o.o_orderdate) + year(o.o_orderdate) % 2 AS INTEGER) AS cycle,
         c.c_name AS CAND_NAME, c.c_mktsegment AS CAND_PTY_AFFILIATION,
         (['P','S','H','X', NULL::VARCHAR])[n.n_regionkey + 1] AS CAND_OFFICE,
         n.n_name AS CAND_OFFICE_ST, o.o_orderstatus AS CAND_OFFICE_DISTRICT,
         CAST(year(o.o_orderdate) AS VARCHAR) AS CAND_ELECTION_YR,
         o.o_orderstatus AS CAND_ICI, o.o_orderstatus AS CAND_STATUS, CAST(NULL AS VARCHAR) AS CAND_PCC
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
"""


_PART_MASTER = """
  SELECT p_partkey AS CAND_ID, CAST(1994 + 2 * (p_size % 4) AS INTEGER) AS cycle,
         CASE p_size % 5 WHEN 0 THEN upper(w2) || ', ' || upper(w1)
                         WHEN 1 THEN upper(w2) || ', DR ' || upper(w1) || ' ' || p_type
                         WHEN 2 THEN w1 || '  ' || w2
                         WHEN 3 THEN upper(w2) || ', ' || upper(w1) || ' Q JR'
                         ELSE upper(w2) || ',' || upper(w1) || ', III' END AS CAND_NAME,
         p_brand AS CAND_PTY_AFFILIATION,
         (['P','S','H', NULL::VARCHAR])[p_size % 4 + 1] AS CAND_OFFICE,
         p_type AS CAND_OFFICE_ST,
         lpad(CAST(p_size % 10 AS VARCHAR), 2, '0') AS CAND_OFFICE_DISTRICT,
         CASE WHEN p_size % 7 = 0 THEN NULL
              ELSE CAST(1994 + 2 * (p_size % 4) + (p_size % 3) * 2 AS VARCHAR) END AS CAND_ELECTION_YR,
         'C' AS CAND_ICI, 'N' AS CAND_STATUS, NULL::VARCHAR AS CAND_PCC
  FROM (SELECT *, split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2 FROM part)
"""


def name_parts_ctes(src: str, name_col: str, p: str = "np") -> str:
    """C1 (ASCII) + C3 as CTE steps over ``src``; the last CTE is named ``p``."""
    return f"""
{p}1 AS (SELECT *, upper(trim(regexp_replace({name_col}, '\\s+', ' ', 'g'))) AS normalized_name FROM {src}),
{p}2 AS (SELECT *, list_transform(string_split(normalized_name, ','), lambda p: trim(p)) AS np_parts FROM {p}1),
{p}3 AS (SELECT *, list_filter(string_split(np_parts[1], ' '), lambda t: t <> '') AS np_toks,
               list_filter(string_split(coalesce(np_parts[2], ''), ' '), lambda t: t <> '') AS np_rest FROM {p}2),
{p}4 AS (SELECT *, (len(np_rest) > 0 AND np_rest[1] IN ('DR','HON','GOV','SEN','REP')) AS np_has_prefix FROM {p}3),
{p}5 AS (SELECT *, CASE WHEN np_has_prefix THEN np_rest[2:] ELSE np_rest END AS np_rest2 FROM {p}4),
{p}6 AS (SELECT *, (len(np_rest2) > 0 AND np_rest2[len(np_rest2)] IN ('JR','SR','II','III','IV')) AS np_has_suffix FROM {p}5),
{p}7 AS (SELECT *, CASE WHEN np_has_suffix THEN np_rest2[1:len(np_rest2)-1] ELSE np_rest2 END AS np_rest3 FROM {p}6),
{p} AS (SELECT *,
   CASE WHEN normalized_name IS NULL THEN NULL WHEN len(np_parts) = 1 THEN np_toks[1] ELSE np_rest2[1] END AS first_name,
   CASE WHEN normalized_name IS NULL THEN NULL
        WHEN len(np_parts) = 1 THEN (CASE WHEN len(np_toks) > 2 THEN array_to_string(np_toks[2:len(np_toks)-1], ' ') END)
        ELSE (CASE WHEN len(np_rest3) > 1 THEN array_to_string(np_rest3[2:], ' ') END) END AS middle_name,
   CASE WHEN normalized_name IS NULL THEN NULL
        WHEN len(np_parts) = 1 THEN (CASE WHEN len(np_toks) > 1 THEN np_toks[len(np_toks)] END)
        ELSE nullif(np_parts[1], '') END AS last_name,
   CASE WHEN len(np_parts) > 1 AND np_has_prefix THEN np_rest[1] END AS prefix,
   CASE WHEN len(np_parts) > 1 AND np_has_suffix THEN np_rest2[len(np_rest2)] END AS suffix
 FROM {p}7)"""


def candidate_dim_ctes(master_sql: str, out: str = "cdim", p: str = "np") -> str:
    """Candidate dimension (P3-P5, A4) from a candidate-master query; CTE ``out``."""
    return f"""
{p}m AS ({master_sql}),
{name_parts_ctes(p + 'm', 'CAND_NAME', p)},
{p}proj AS (
  SELECT CAND_ID AS cand_id, cycle, CAND_NAME AS display_name, first_name, middle_name, last_name, prefix, suffix,
         CAND_PTY_AFFILIATION AS party, CAND_OFFICE AS office, CAND_OFFICE_ST AS state,
         CAND_OFFICE_DISTRICT AS district, CAND_ELECTION_YR AS candidate_election_year,
         CAND_ICI AS incumbent_challenger_status, CAND_STATUS AS status, normalized_name,
         CAND_PCC AS principal_campaign_committee
  FROM {p}),
{out} AS (
  SELECT * EXCLUDE (rn), concat_ws(' ', normalized_name, display_name) AS search_text,
         CASE office WHEN 'P' THEN 'President' WHEN 'S' THEN 'Senate' WHEN 'H' THEN 'House' END AS office_full
  FROM (SELECT *, row_number() OVER (PARTITION BY cand_id, cycle ORDER BY
          display_name NULLS FIRST, first_name NULLS FIRST, middle_name NULLS FIRST, last_name NULLS FIRST,
          prefix NULLS FIRST, suffix NULLS FIRST, party NULLS FIRST, office NULLS FIRST, state NULLS FIRST,
          district NULLS FIRST, candidate_election_year NULLS FIRST, incumbent_challenger_status NULLS FIRST,
          status NULLS FIRST, normalized_name NULLS FIRST, principal_campaign_committee NULLS FIRST) AS rn
        FROM {p}proj) WHERE rn = 1)"""


_CANDIDATE_DIM_CTES = candidate_dim_ctes(_CANDIDATE_MASTER)

_COMMITTEE_DIM_CTES = f"""
rsc AS (SELECT DISTINCT committee_id, two_year_transaction_period FROM ({_RECEIPTS})),
cmaster AS (
  SELECT s.s_suppkey AS cmte_id, r.two_year_transaction_period AS cycle, s.s_name AS name,
         NULL::VARCHAR AS treasurer, NULL::VARCHAR AS street_1, NULL::VARCHAR AS street_2, NULL::VARCHAR AS city,
         CAST(s.s_nationkey AS VARCHAR) AS state, NULL::VARCHAR AS zip,
         CASE WHEN s.s_nationkey % 2 = 0 THEN 'U' END AS designation,
         CASE WHEN s.s_nationkey % 3 = 0 THEN 'N' WHEN s.s_nationkey % 3 = 1 THEN 'Q' END AS committee_type,
         NULL::VARCHAR AS party_affiliation, NULL::VARCHAR AS filing_frequency, 'C' AS org_type,
         NULL::VARCHAR AS connected_org, NULL::BIGINT AS principal_candidate_id
  FROM rsc r JOIN supplier s ON r.committee_id = s.s_suppkey),
cmdim AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY cmte_id, cycle ORDER BY name NULLS FIRST, treasurer NULLS FIRST,
       street_1 NULLS FIRST, street_2 NULLS FIRST, city NULLS FIRST, state NULLS FIRST, zip NULLS FIRST,
       designation NULLS FIRST, committee_type NULLS FIRST, party_affiliation NULLS FIRST,
       filing_frequency NULLS FIRST, org_type NULLS FIRST, connected_org NULLS FIRST,
       principal_candidate_id NULLS FIRST) AS rn
    FROM cmaster) WHERE rn = 1)"""

_LINKS_CTES = f"""
lcm AS (SELECT DISTINCT committee_id, two_year_transaction_period FROM ({_RECEIPTS})),
links AS (
  SELECT CAST(committee_id AS BIGINT) AS cand_id, committee_id AS cmte_id, two_year_transaction_period AS cycle,
         'H' AS committee_type_code, 'P' AS designation_code FROM lcm
  UNION ALL
  SELECT CAST(committee_id * 2 + 1 AS BIGINT), committee_id, two_year_transaction_period, NULL, 'J' FROM lcm),
roles AS (
  SELECT *, CASE WHEN designation_code IN ('P','A') THEN 'principal'
                 WHEN designation_code IN ('J') THEN 'joint_fundraising'
                 WHEN designation_code IN ('L') THEN 'leadership' ELSE 'other' END AS role
  FROM links),
cc AS (
  SELECT r.cmte_id, r.cycle, r.cand_id, r.role, d.name, d.treasurer, d.street_1, d.street_2, d.city, d.state,
         d.zip, coalesce(d.designation, r.designation_code) AS designation,
         coalesce(d.committee_type, r.committee_type_code) AS committee_type, d.party_affiliation,
         d.filing_frequency, d.org_type, d.connected_org, d.principal_candidate_id,
         (r.role = 'principal') AS principal_flag
  FROM roles r LEFT JOIN cmdim d ON r.cmte_id = d.cmte_id AND r.cycle = d.cycle)"""

SQL["dim_dedup"] = f"""
WITH {_CANDIDATE_DIM_CTES}
SELECT cand_id, cycle, display_name, first_name, middle_name, last_name, prefix, suffix, party, office, state,
       district, candidate_election_year, incumbent_challenger_status, status, normalized_name,
       principal_campaign_committee, search_text, office_full
FROM cdim
"""

SQL["committee_roles"] = f"""
WITH {_COMMITTEE_DIM_CTES}, {_LINKS_CTES}
SELECT * FROM cc
"""

SQL["receipts_flat"] = f"""
WITH {_CANDIDATE_DIM_CTES}, {_COMMITTEE_DIM_CTES}, {_LINKS_CTES},
raw AS (
  SELECT committee_id, CASE WHEN entity_type = 'COM' THEN candidate_id END AS candidate_id,
         two_year_transaction_period, contribution_receipt_amount
  FROM ({_RECEIPTS})),
flat AS (
  SELECT coalesce(sa.candidate_id, cc.cand_id) AS candidate_id,
         cd.display_name AS candidate_name, cd.office AS candidate_office,
         cm.committee_type AS recipient_committee_type, cm.designation AS recipient_committee_designation,
         sa.two_year_transaction_period, sa.contribution_receipt_amount
  FROM raw sa
  LEFT JOIN cc ON sa.committee_id = cc.cmte_id AND sa.two_year_transaction_period = cc.cycle
  LEFT JOIN cdim cd ON coalesce(cc.cand_id, sa.candidate_id) = cd.cand_id AND sa.two_year_transaction_period = cd.cycle
  LEFT JOIN cmdim cm ON sa.committee_id = cm.cmte_id AND sa.two_year_transaction_period = cm.cycle)
SELECT candidate_id, candidate_name, candidate_office, recipient_committee_type, recipient_committee_designation,
       two_year_transaction_period, COUNT(*) AS n_rows,
       CAST(SUM(CAST(contribution_receipt_amount AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM flat GROUP BY ALL
"""

# the summary of the flat receipts, which the receipts job publishes
_CENTS = "CAST(contribution_receipt_amount AS DECIMAL(18,2))"
SQL["receipts_job"] = f"""
WITH {_CANDIDATE_DIM_CTES}, {_COMMITTEE_DIM_CTES}, {_LINKS_CTES},
raw AS (
  SELECT committee_id, CASE WHEN entity_type = 'COM' THEN candidate_id END AS candidate_id, entity_type, two_year_transaction_period, contribution_receipt_amount FROM ({_RECEIPTS})),
flat AS (
  SELECT coalesce(sa.candidate_id, cc.cand_id) AS candidate_id, sa.two_year_transaction_period AS cycle, entity_type, contribution_receipt_amount
  FROM raw sa LEFT JOIN cc ON sa.committee_id = cc.cmte_id AND sa.two_year_transaction_period = cc.cycle),
s AS (
  SELECT candidate_id, cycle, CAST(SUM({_CENTS}) AS DOUBLE) AS total_receipts,
       CAST(SUM(CASE WHEN entity_type = 'IND' THEN {_CENTS} ELSE 0 END) AS DOUBLE) AS individual_receipts,
       CAST(SUM(CASE WHEN entity_type IN ('CCM','COM') THEN {_CENTS} ELSE 0 END) AS DOUBLE) AS committee_receipts,
       CAST(SUM(CASE WHEN entity_type = 'PTY' THEN {_CENTS} ELSE 0 END) AS DOUBLE) AS party_receipts,
       COUNT(*) AS transaction_count
  FROM flat WHERE candidate_id IS NOT NULL GROUP BY ALL)
SELECT s.candidate_id, s.cycle, d.display_name, total_receipts, individual_receipts, committee_receipts, party_receipts, transaction_count
FROM s LEFT JOIN cdim d ON s.candidate_id = d.cand_id AND s.cycle = d.cycle
"""

_SUMMARY_SQL = f"""
  SELECT candidate_id, two_year_transaction_period AS cycle,
       CAST(SUM(CAST(contribution_receipt_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_receipts,
       CAST(SUM(CASE WHEN entity_type = 'IND' THEN CAST(contribution_receipt_amount AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS individual_receipts,
       CAST(SUM(CASE WHEN entity_type IN ('CCM','COM') THEN CAST(contribution_receipt_amount AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS committee_receipts,
       CAST(SUM(CASE WHEN entity_type = 'PTY' THEN CAST(contribution_receipt_amount AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS party_receipts,
       COUNT(*) AS transaction_count
  FROM ({_RECEIPTS}) WHERE candidate_id IS NOT NULL GROUP BY 1, 2
"""

SQL["candidate_summary_lookup"] = f"""
WITH {_CANDIDATE_DIM_CTES}, s AS ({_SUMMARY_SQL})
SELECT c.cand_id, c.cycle, c.display_name, c.party, c.office, c.office_full, c.state, c.district,
       s.total_receipts, s.individual_receipts, s.committee_receipts, s.party_receipts, s.transaction_count
FROM cdim c LEFT JOIN s ON c.cand_id = s.candidate_id AND c.cycle = s.cycle
WHERE c.cand_id = 1
"""

SQL["history_page"] = f"""
SELECT * EXCLUDE (nationkey) FROM ({_RECEIPTS})
WHERE candidate_id = 1 AND two_year_transaction_period IN (1996, 1998)
ORDER BY contribution_receipt_date DESC NULLS FIRST, candidate_id, committee_id, two_year_transaction_period,
         report_year, report_type, contributor_name, entity_type, contribution_receipt_amount, l_orderkey
LIMIT 20 OFFSET 20
"""

# page 3 by keys; the tie-breaker is the query's own
SQL["history_by_key"] = f"""
SELECT *, lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || CAST(committee_id AS VARCHAR) || '-' || contributor_name AS sub_id
FROM (SELECT * EXCLUDE (nationkey) FROM ({_RECEIPTS})) WHERE candidate_id = 1
ORDER BY contribution_receipt_date DESC NULLS FIRST, sub_id LIMIT 10 OFFSET 20
"""

SQL["top_lookup"] = SQL["top_contributors"].replace(
    ") WHERE rk <= 20",
    ") WHERE rk <= 20 AND candidate_id = 1\nORDER BY cycle DESC NULLS FIRST, total_amount DESC NULLS FIRST, "
    "contributor_name ASC NULLS LAST, entity_type ASC NULLS LAST LIMIT 20",
)

SQL["candidate_search"] = f"""
WITH {candidate_dim_ctes(_PART_MASTER, "pdim", "pp")}
SELECT cand_id, cycle, display_name, normalized_name, party, office, office_full, state, district,
       candidate_election_year
FROM pdim WHERE search_text ILIKE '%small%ring%'
ORDER BY cycle DESC NULLS FIRST, display_name ASC NULLS LAST, cand_id ASC NULLS LAST
LIMIT 50
"""

SQL["name_index_search"] = SQL["candidate_search"]

SQL["name_parts"] = f"""
WITH pm AS ({_PART_MASTER}), {name_parts_ctes('pm', 'CAND_NAME', 'np')}
SELECT CAND_ID AS cand_id, CAND_NAME AS display_name, normalized_name, first_name, middle_name, last_name,
       prefix, suffix
FROM np
"""

SQL["cycle_union"] = f"""
WITH {candidate_dim_ctes("SELECT * EXCLUDE (o_orderkey) FROM (" + _CANDIDATE_MASTER + ") UNION ALL BY NAME " + _PART_MASTER, "udim", "up")}
SELECT cycle, office_full, COUNT(*) AS n_candidates, COUNT(DISTINCT cand_id) AS n_ids
FROM udim GROUP BY cycle, office_full
"""

# --- bulk names, number text, JSON maps, text normalisation -------------------

SQL["column_aliases"] = """
SELECT CAST(l.l_suppkey AS VARCHAR) AS committee_id,
       CAST(l.l_partkey AS VARCHAR) AS contributor_name,
       o.o_orderpriority AS contbr_nm,
       strftime(l.l_shipdate, '%m%d%Y') AS contribution_receipt_date,
       CAST(l.l_extendedprice AS VARCHAR) AS contribution_receipt_amount,
       l.l_returnflag AS entity_type,
       l.l_linestatus AS report_type,
       CAST(year(l.l_shipdate) AS VARCHAR) AS report_year,
       CAST(o.o_custkey AS VARCHAR) AS candidate_id,
       CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
       CASE WHEN l.l_returnflag = 'R' THEN 'X' END AS memo_code,
       NULL::VARCHAR AS recipient_committee_type, NULL::VARCHAR AS recipient_committee_org_type,
       NULL::VARCHAR AS recipient_committee_designation, NULL::VARCHAR AS candidate_name,
       NULL::VARCHAR AS candidate_first_name, NULL::VARCHAR AS candidate_last_name,
       NULL::VARCHAR AS candidate_middle_name, NULL::VARCHAR AS candidate_prefix, NULL::VARCHAR AS candidate_suffix,
       NULL::VARCHAR AS candidate_office, NULL::VARCHAR AS candidate_office_state,
       NULL::VARCHAR AS candidate_office_district, NULL::VARCHAR AS sub_id
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""


def _pf(x: str) -> str:
    from .market_oracle_sql import pf

    return pf(x)


def _safe_int(x: str) -> str:
    from .market_oracle_sql import safe_int_sql

    return safe_int_sql(x)


SQL["parse_numbers"] = f"""
WITH t AS (
  SELECT event_id,
    CASE event_id % 8 WHEN 0 THEN CAST(value AS VARCHAR) WHEN 1 THEN ' ' || CAST(value AS VARCHAR) || ' '
      WHEN 2 THEN 'null' WHEN 3 THEN '' WHEN 4 THEN CAST(value AS VARCHAR) || 'abc'
      WHEN 5 THEN replace(CAST(value AS VARCHAR), '.', '_') WHEN 6 THEN 'inf'
      ELSE CAST(value AS VARCHAR) || 'd' END AS number_text,
    CASE event_id % 4 WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 1 THEN CAST(user_id AS VARCHAR) || '.0'
      WHEN 2 THEN ' ' || CAST(user_id AS VARCHAR) ELSE 'x' END AS int_text
  FROM events)
SELECT event_id, number_text, {_pf('number_text')} AS number, int_text, {_safe_int('int_text')} AS int_value FROM t
"""

SQL["committee_map"] = """
SELECT event_id, unnest(map_keys(m)) AS key, unnest(map_values(m)) AS value
FROM (SELECT event_id, CAST(json(props) AS MAP(VARCHAR, VARCHAR)) AS m FROM events)
"""


def _nfkd_chain(x: str) -> str:
    """NFKD for Latin text: every code point of U+00A0..U+024F whose NFKD
    form differs is replaced by that form (table built from the rule)."""
    import unicodedata

    expr = x
    for cp in range(0xA0, 0x250):
        ch = chr(cp)
        dec = unicodedata.normalize("NFKD", ch)
        if dec != ch:
            expr = f"replace({expr}, '{ch}', '{dec.replace(chr(39), chr(39) * 2)}')"
    return expr


def _normalized_text_sql() -> str:
    from .market_oracle_sql import PY_SPACE

    upper = f"upper(replace({_nfkd_chain('text')}, 'ß', 'SS'))"
    norm = f"trim(regexp_replace({upper}, '{PY_SPACE}+', ' ', 'g'))"
    cls = PY_SPACE[1:-1]
    return f"""
WITH n AS (SELECT doc_id, {norm} AS normalized FROM documents)
SELECT doc_id, normalized, regexp_replace(normalized, '[^\\p{{L}}\\p{{N}}_{cls}]', ' ', 'g') AS stripped FROM n
"""


SQL["normalized_text"] = _normalized_text_sql()

SQL["lookup_json"] = f"""
WITH {candidate_dim_ctes(_PART_MASTER, "pdim", "pp")},
hits AS (
  SELECT cand_id, cycle, display_name, normalized_name, party, office, office_full, state, district,
         candidate_election_year
  FROM pdim WHERE search_text ILIKE '%small%ring%'
  ORDER BY cycle DESC NULLS FIRST, display_name ASC NULLS LAST, cand_id ASC NULLS LAST
  LIMIT 50)
SELECT to_json({{'cand_id': cand_id, 'candidate_election_year': candidate_election_year, 'cycle': cycle,
                'display_name': display_name, 'district': district, 'normalized_name': normalized_name,
                'office': office, 'office_full': office_full, 'party': party, 'state': state}}) AS json
FROM hits
"""
