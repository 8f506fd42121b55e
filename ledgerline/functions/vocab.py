"""Fixed values.

Everything in this module is a fixed value that has to equal the original
application's vocabulary for results to agree: word lists, ordered regex
lists, lookup tables and seed rows. They are kept as plain text in their
natural order. Order matters wherever a rule takes the first match.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — bulk-file schemas
# ---------------------------------------------------------------------------

SCHEDULE_A_DEFAULT_COLUMNS = (
    "committee_id", "committee_name", "report_year", "report_type", "image_number",
    "filing_form", "link_id", "line_number", "transaction_id", "file_number",
    "entity_type", "entity_type_desc", "unused_contbr_id", "contributor_prefix",
    "contributor_name", "recipient_committee_type", "recipient_committee_org_type",
    "recipient_committee_designation", "contributor_first_name", "contributor_middle_name",
    "contributor_last_name", "contributor_suffix", "contributor_street_1",
    "contributor_street_2", "contributor_city", "contributor_state", "contributor_zip",
    "contributor_employer", "contributor_occupation", "contributor_id", "is_individual",
    "receipt_type", "receipt_type_desc", "receipt_type_full", "memo_code", "memo_code_full",
    "memo_text", "contribution_receipt_date", "contribution_receipt_amount",
    "contributor_aggregate_ytd", "candidate_id", "candidate_name", "candidate_first_name",
    "candidate_last_name", "candidate_middle_name", "candidate_prefix", "candidate_suffix",
    "candidate_office", "candidate_office_full", "candidate_office_state",
    "candidate_office_state_full", "candidate_office_district", "conduit_committee_id",
    "conduit_committee_name", "conduit_committee_street1", "conduit_committee_street2",
    "conduit_committee_city", "conduit_committee_state", "conduit_committee_zip",
    "donor_committee_name", "national_committee_nonfederal_account", "election_type",
    "election_type_full", "fec_election_type_desc", "fec_election_year",
    "two_year_transaction_period", "amendment_indicator", "amendment_indicator_desc",
    "schedule_type", "schedule_type_full", "increased_limit", "load_date", "sub_id",
    "original_sub_id", "back_reference_transaction_id", "back_reference_schedule_name",
    "pdf_url", "line_number_label",
)

SCHEDULE_B_DEFAULT_COLUMNS = (
    "committee_id", "committee_name", "report_year", "report_type", "image_number",
    "filing_form", "line_number", "transaction_id", "entity_type", "entity_type_desc",
    "recipient_name", "recipient_city", "recipient_state", "recipient_zip",
    "recipient_organization", "recipient_principal", "disbursement_description",
    "disbursement_date", "disbursement_amount", "memo_code", "memo_text", "candidate_id",
    "candidate_name", "candidate_office", "candidate_state", "candidate_district",
    "two_year_transaction_period", "schedule_type", "load_date", "sub_id",
)

SCHEDULE_E_DEFAULT_COLUMNS = (
    "committee_id", "committee_name", "report_year", "image_number", "filing_form",
    "line_number", "transaction_id", "candidate_id", "candidate_name", "candidate_party",
    "candidate_office", "candidate_state", "candidate_district", "payee_name", "payee_city",
    "payee_state", "payee_zip", "expenditure_date", "expenditure_amount",
    "expenditure_purpose", "support_oppose_code", "support_oppose_description",
    "election_type", "two_year_transaction_period", "load_date", "sub_id",
)

# Raw bulk column -> canonical name, in order. A target that already exists
# is not overwritten, so of two sources for one target the first one wins.
SCHEDULE_A_COLUMN_ALIASES = (
    ("cmte_id", "committee_id"),
    ("cmte_nm", "committee_name"),
    ("rpt_yr", "report_year"),
    ("rpt_tp", "report_type"),
    ("image_num", "image_number"),
    ("form_tp_cd", "filing_form"),
    ("line_num", "line_number"),
    ("tran_id", "transaction_id"),
    ("file_num", "file_number"),
    ("entity_tp", "entity_type"),
    ("entity_tp_desc", "entity_type_desc"),
    ("name", "contributor_name"),
    ("contbr_nm", "contributor_name"),
    ("contbr_first_nm", "contributor_first_name"),
    ("contbr_mid_nm", "contributor_middle_name"),
    ("contbr_last_nm", "contributor_last_name"),
    ("contbr_prefix", "contributor_prefix"),
    ("contbr_suffix", "contributor_suffix"),
    ("contbr_st1", "contributor_street_1"),
    ("contbr_st2", "contributor_street_2"),
    ("contbr_city", "contributor_city"),
    ("contbr_st", "contributor_state"),
    ("contbr_zip", "contributor_zip"),
    ("contbr_employer", "contributor_employer"),
    ("contbr_occupation", "contributor_occupation"),
    ("contbr_id", "contributor_id"),
    ("receipt_tp", "receipt_type"),
    ("receipt_desc", "receipt_type_desc"),
    ("receipt_desc_full", "receipt_type_full"),
    ("memo_cd", "memo_code"),
    ("memo_cd_desc", "memo_code_full"),
    ("memo_text", "memo_text"),
    ("contb_receipt_dt", "contribution_receipt_date"),
    ("transaction_dt", "contribution_receipt_date"),
    ("contb_receipt_amt", "contribution_receipt_amount"),
    ("transaction_amt", "contribution_receipt_amount"),
    ("contb_aggreg_amt", "contributor_aggregate_ytd"),
    ("cand_id", "candidate_id"),
    ("cmte_tp", "recipient_committee_type"),
    ("cmte_dsgn", "recipient_committee_designation"),
    ("cmte_org_tp", "recipient_committee_org_type"),
    ("back_ref_tran_id", "back_reference_transaction_id"),
    ("back_ref_sched_nm", "back_reference_schedule_name"),
    ("election_tp", "election_type"),
    ("election_tp_desc", "election_type_full"),
    ("fec_election_tp_desc", "fec_election_type_desc"),
)

# ---------------------------------------------------------------------------
# FIXED VALUES — dimension codes
# ---------------------------------------------------------------------------

OFFICE_DESCRIPTIONS = (("P", "President"), ("S", "Senate"), ("H", "House"))

# designation code(s) -> committee role; anything else (NULL included) is "other"
COMMITTEE_ROLES = ((("P", "A"), "principal"), (("J",), "joint_fundraising"), (("L",), "leadership"))
OTHER_ROLE = "other"

NAME_PREFIXES = ("DR", "HON", "GOV", "SEN", "REP")
NAME_SUFFIXES = ("JR", "SR", "II", "III", "IV")

# entity types counted by the summary fact
INDIVIDUAL_ENTITY_TYPES = ("IND",)
COMMITTEE_ENTITY_TYPES = ("CCM", "COM")
PARTY_ENTITY_TYPES = ("PTY",)

TOP_CONTRIBUTORS_LIMIT = 20

# ---------------------------------------------------------------------------
# FIXED VALUES — market election filters
# ---------------------------------------------------------------------------

# event text: any of these words as a substring
ELECTION_KEYWORDS = (
    "election", "primary", "runoff", "ballot", "governor", "mayor", "parliament",
    "president", "assembly", "congress", "senate", "house", "bundestag", "reichstag",
    "nomination", "legislative", "minister",
)

# market question: any of these, case-insensitive
QUESTION_PATTERNS = (
    r"\bwin(s)?\b",
    r"\bwinner\b",
    r"\bbe\s+elected\b",
    r"\belected\b",
    r"\bbe\s+inaugurated\b",
    r"\binaugurated\b",
    r"\bnominee\b",
    r"\bnomination\b",
    r"\bd[- ]?nom\b",
    r"\bbe\s+the\s+next\b",
    r"\bmajority\b",
    r"\bseat\b",
    r"\bcontrol\b",
    r"\brunoff\b",
)

# analytics tags: a trimmed lower-case tag equal to one of these
ELECTION_TAGS = (
    "election", "elections", "general election", "presidential", "president", "primary",
    "runoff", "by-election", "byelection", "leadership election", "senate", "house",
    "congress", "parliament", "assembly", "legislative", "governor", "gubernatorial",
    "mayor", "minister",
)
# tags of other domains; listed for completeness, they do not change the rule

WINNER_PRICE_THRESHOLD = 0.8
RECENT_WINDOW_DAYS = 365 * 2
PLATFORM = "Polymarket"

# ---------------------------------------------------------------------------
# FIXED VALUES — office inference (ordered by priority)
# ---------------------------------------------------------------------------

OFFICE_PATTERNS = (
    ("President", (r"\bpresident\b", r"\bwhite house\b", r"\bpotus\b", r"\boval office\b")),
    ("Vice President", (r"\bvice president\b", r"\bvice-presidential\b", r"\bvp\b")),
    ("Prime Minister", (r"\bprime minister\b", r"\bpm election\b")),
    ("Senate", (r"\bsenate\b", r"\bsenator\b", r"\bupper house\b")),
    ("House", (r"\bhouse of representatives\b", r"\bus house\b", r"\bcongress\b",
               r"\bcongressional\b", r"\brepresentative\b")),
    ("Governor", (r"\bgovernor\b", r"\bgubernatorial\b", r"\bgovernorship\b")),
    ("Lieutenant Governor", (r"\blieutenant governor\b", r"\blt\.? governor\b")),
    ("Attorney General", (r"\battorney general\b",)),
    ("Secretary of State", (r"\bsecretary of state\b",)),
    ("State Legislature", (r"\bstate legislature\b", r"\bstate senate\b", r"\bstate house\b",
                           r"\bstate assembly\b", r"\blegislative assembly\b")),
    ("Mayor", (r"\bmayor\b", r"\bmayoral\b")),
    ("City Council", (r"\bcity council\b", r"\bcouncilmember\b", r"\bcouncil seat\b")),
    ("Parliament", (r"\bparliament\b", r"\bmember of parliament\b", r"\bmp election\b")),
    ("European Parliament", (r"\beuropean parliament\b",)),
)
# a "House" hit does not count when the text mentions this phrase
HOUSE_EXCEPTION_PHRASE = "white house"

# ---------------------------------------------------------------------------
# FIXED VALUES — US states and territories (abbreviation, name), ordered
# ---------------------------------------------------------------------------

US_DIVISIONS = (
    ("AL", "Alabama"), ("AK", "Alaska"), ("AS", "American Samoa"), ("AZ", "Arizona"),
    ("AR", "Arkansas"), ("CA", "California"), ("CO", "Colorado"), ("CT", "Connecticut"),
    ("DE", "Delaware"), ("DC", "District of Columbia"), ("FL", "Florida"), ("GA", "Georgia"),
    ("GU", "Guam"), ("HI", "Hawaii"), ("ID", "Idaho"), ("IL", "Illinois"), ("IN", "Indiana"),
    ("IA", "Iowa"), ("KS", "Kansas"), ("KY", "Kentucky"), ("LA", "Louisiana"), ("ME", "Maine"),
    ("MD", "Maryland"), ("MA", "Massachusetts"), ("MI", "Michigan"), ("MN", "Minnesota"),
    ("MS", "Mississippi"), ("MO", "Missouri"), ("MT", "Montana"), ("NE", "Nebraska"),
    ("NV", "Nevada"), ("NH", "New Hampshire"), ("NJ", "New Jersey"), ("NM", "New Mexico"),
    ("NY", "New York"), ("NC", "North Carolina"), ("ND", "North Dakota"),
    ("MP", "Northern Mariana Islands"), ("OH", "Ohio"), ("OK", "Oklahoma"), ("OR", "Oregon"),
    ("PA", "Pennsylvania"), ("PR", "Puerto Rico"), ("PW", "Republic of Palau"),
    ("RI", "Rhode Island"), ("SC", "South Carolina"), ("SD", "South Dakota"),
    ("TN", "Tennessee"), ("TX", "Texas"), ("UT", "Utah"), ("VT", "Vermont"), ("VA", "Virginia"),
    ("VI", "U.S. Virgin Islands"), ("WA", "Washington"), ("WV", "West Virginia"),
    ("WI", "Wisconsin"), ("WY", "Wyoming"),
)

# Official election office sites per state/territory.
STATE_OFFICIAL_SITES = (
    ("Alabama", "https://www.sos.alabama.gov/alabama-votes"),
    ("Alaska", "https://www.elections.alaska.gov/"),
    ("American Samoa", "https://aselectionoffice.gov/"),
    ("Arizona", "https://azsos.gov/elections"),
    ("Arkansas", "https://www.sos.arkansas.gov/elections"),
    ("California", "https://www.sos.ca.gov/elections"),
    ("Colorado", "https://www.sos.state.co.us/pubs/elections/main.html"),
    ("Connecticut", "https://portal.ct.gov/sots/common-elements/v5-template---redesign/elections--voting--home-page"),
    ("Delaware", "https://elections.delaware.gov/index.shtml"),
    ("District of Columbia", "https://dcboe.org/"),
    ("Federated States of Micronesia", "https://www.fsmned.fm/"),
    ("Florida", "https://www.dos.myflorida.com/elections/"),
    ("Georgia", "https://sos.ga.gov/elections-division-georgia-secretary-states-office"),
    ("Guam", "https://gec.guam.gov/"),
    ("Hawaii", "https://elections.hawaii.gov/"),
    ("Idaho", "https://voteidaho.gov/"),
    ("Illinois", "https://www.elections.il.gov/"),
    ("Indiana", "https://indianavoters.in.gov/"),
    ("Iowa", "https://sos.iowa.gov/elections/voterinformation/index.html"),
    ("Kansas", "https://sos.ks.gov/elections/elections.html"),
    ("Kentucky", "https://elect.ky.gov/Pages/default.aspx"),
    ("Louisiana", "https://www.sos.la.gov/ElectionsAndVoting/Pages/default.aspx"),
    ("Maine", "https://www.maine.gov/sos/cec/elec/index.html"),
    ("Maryland", "https://elections.maryland.gov/"),
    ("Massachusetts", "https://www.sec.state.ma.us/divisions/elections/elections-and-voting.htm"),
    ("Michigan", "https://www.michigan.gov/sos/elections"),
    ("Minnesota", "https://www.sos.state.mn.us/elections-voting/"),
    ("Mississippi", "https://www.sos.ms.gov/elections-voting"),
    ("Missouri", "https://www.sos.mo.gov/elections/"),
    ("Montana", "https://sosmt.gov/elections/"),
    ("Nebraska", "https://www.nebraska.gov/featured/elections-voting/"),
    ("Nevada", "https://www.nvsos.gov/sos/elections"),
    ("New Hampshire", "https://www.sos.nh.gov/elections/voters"),
    ("New Jersey", "https://www.nj.gov/state/elections/vote.shtml"),
    ("New Mexico", "https://www.sos.nm.gov/voting-and-elections/voter-information-portal-nmvote-org/"),
    ("New York", "https://www.elections.ny.gov/"),
    ("North Carolina", "https://www.ncsbe.gov/"),
    ("North Dakota", "https://vip.sos.nd.gov/PortalList.aspx"),
    ("Northern Mariana Islands", "https://www.votecnmi.gov.mp/"),
    ("Ohio", "https://www.sos.state.oh.us/elections/voters/"),
    ("Oklahoma", "https://oklahoma.gov/elections.html"),
    ("Oregon", "https://sos.oregon.gov/voting-elections/Pages/default.aspx"),
    ("Pennsylvania", "https://www.dos.pa.gov/VotingElections/Pages/default.aspx"),
    ("Puerto Rico", "https://ww2.ceepur.org/"),
    ("Republic of Palau", "https://palauelection.org/"),
    ("Rhode Island", "https://vote.sos.ri.gov/"),
    ("South Carolina", "https://www.scvotes.org/"),
    ("South Dakota", "https://sdsos.gov/elections-voting/default.aspx"),
    ("Tennessee", "https://sos.tn.gov/elections"),
    ("Texas", "https://www.sos.state.tx.us/elections/index.shtml"),
    ("U.S. Virgin Islands", "https://vivote.gov/"),
    ("Utah", "https://vote.utah.gov/"),
    ("Vermont", "https://sos.vermont.gov/elections/"),
    ("Virginia", "https://www.elections.virginia.gov/"),
    ("Washington", "https://www.sos.wa.gov/elections"),
    ("West Virginia", "https://sos.wv.gov/elections/pages/default.aspx"),
    ("Wisconsin", "https://myvote.wi.gov/en-us/"),
    ("Wyoming", "https://sos.wyo.gov/Elections/Default.aspx"),
)

# ---------------------------------------------------------------------------
# FIXED VALUES — country keywords (substring -> jurisdiction, level), ordered
# ---------------------------------------------------------------------------

COUNTRY_KEYWORDS = (
    ("united states", "United States", "national"),
    ("usa", "United States", "national"),
    ("u.s.", "United States", "national"),
    ("america", "United States", "national"),
    ("united kingdom", "United Kingdom", "national"),
    ("uk", "United Kingdom", "national"),
    ("britain", "United Kingdom", "national"),
    ("british", "United Kingdom", "national"),
    ("scotland", "United Kingdom - Scotland", "subnational"),
    ("wales", "United Kingdom - Wales", "subnational"),
    ("northern ireland", "United Kingdom - Northern Ireland", "subnational"),
    ("canada", "Canada", "national"),
    ("mexico", "Mexico", "national"),
    ("brazil", "Brazil", "national"),
    ("argentina", "Argentina", "national"),
    ("france", "France", "national"),
    ("germany", "Germany", "national"),
    ("italy", "Italy", "national"),
    ("spain", "Spain", "national"),
    ("portugal", "Portugal", "national"),
    ("india", "India", "national"),
    ("pakistan", "Pakistan", "national"),
    ("israel", "Israel", "national"),
    ("turkey", "Turkey", "national"),
    ("taiwan", "Taiwan", "national"),
    ("china", "China", "national"),
    ("japan", "Japan", "national"),
    ("south korea", "South Korea", "national"),
    ("korea", "South Korea", "national"),
    ("philippines", "Philippines", "national"),
    ("indonesia", "Indonesia", "national"),
    ("nigeria", "Nigeria", "national"),
    ("south africa", "South Africa", "national"),
    ("kenya", "Kenya", "national"),
    ("australia", "Australia", "national"),
    ("new zealand", "New Zealand", "national"),
    ("european union", "European Union", "supra-national"),
    ("european parliament", "European Union", "supra-national"),
    ("europe", "European Union", "supra-national"),
    ("venezuela", "Venezuela", "national"),
    ("peru", "Peru", "national"),
    ("colombia", "Colombia", "national"),
    ("chile", "Chile", "national"),
    ("paraguay", "Paraguay", "national"),
    ("uruguay", "Uruguay", "national"),
    ("panama", "Panama", "national"),
    ("dominican republic", "Dominican Republic", "national"),
    ("ecuador", "Ecuador", "national"),
    ("bolivia", "Bolivia", "national"),
    ("guatemala", "Guatemala", "national"),
    ("honduras", "Honduras", "national"),
    ("el salvador", "El Salvador", "national"),
)

UNCLASSIFIED = ("Unclassified", "unknown")

# ---------------------------------------------------------------------------
# FIXED VALUES — data-source library per country
# (jurisdiction, level, name, url, description, access, update_frequency,
#  feasibility, feasibility_notes), in the original order
# ---------------------------------------------------------------------------

COUNTRY_SOURCE_LIBRARY = (
    ("United States", "national",
     "Federal Election Commission – Certified Results and Filings",
     "https://www.fec.gov/data/",
     "Official certified federal election results, candidate filings, and independent expenditure reports.",
     "Open government data",
     "Daily during election periods; certified results after canvass (weeks).",
     "High",
     "Legally authoritative with structured CSV/JSON downloads; lag tied to state certification but reliable for federal races."),
    ("United States", "national",
     "Associated Press Elections API",
     "https://developer.ap.org/ap-elections-api/",
     "Real-time and historical race calls across federal and statewide contests.",
     "Commercial license",
     "Minutes during election night; periodic thereafter.",
     "High",
     "Industry-standard feed for rapid projections; requires paid access and integration work."),
    ("United States", "national",
     "MIT Election Data and Science Lab – Official Returns",
     "https://electionlab.mit.edu/data",
     "Aggregated precinct- and county-level results in machine-readable formats.",
     "Open academic use",
     "Released weeks to months after certification.",
     "Medium",
     "High data quality but slower refresh cadence; excellent for retrospective validation."),
    ("United Kingdom", "national",
     "UK Electoral Commission – Results and Turnout",
     "https://www.electoralcommission.org.uk/research-voting-and-elections",
     "Official UK parliamentary and local election results with downloadable datasets.",
     "Open government data",
     "Certified results published within days of counts.",
     "High",
     "Primary authority for certified vote totals; limited to official counts (no projections)."),
    ("United Kingdom", "national",
     "BBC Elections Live Results",
     "https://www.bbc.com/news/election",
     "Live constituency-level reporting with history and contextual analysis.",
     "Open web (API unofficial)",
     "Minutes on election night; archived pages post-event.",
     "Medium",
     "Timely updates; scraping required for automation and subject to layout drift."),
    ("United Kingdom", "national",
     "Press Association Elections Database",
     "https://www.pressassociation.com/solutions/elections/",
     "Syndicated constituency results feed consumed by major newsrooms.",
     "Commercial license",
     "Real-time on election night.",
     "High",
     "Robust infrastructure with SLA-backed updates; procurement and per-seat pricing required."),
    ("Canada", "national",
     "Elections Canada – Official Voting Results",
     "https://www.elections.ca/content.aspx?section=res&dir=rep/oth/ovr&document=index&lang=e",
     "Certified federal election results down to riding level.",
     "Open government data",
     "Released after official tabulation (days to weeks).",
     "High",
     "Authoritative with CSV and machine-readable formats; slower than media projections."),
    ("Canada", "national",
     "CBC News Elections Dashboard",
     "https://newsinteractives.cbc.ca/elections/",
     "Live results and historical context for federal and provincial races.",
     "Open web",
     "Minutes during election night; archived thereafter.",
     "Medium",
     "Timely but requires scraping or manual download; APIs not public."),
    ("Mexico", "national",
     "Instituto Nacional Electoral (INE)",
     "https://www.ine.mx/",
     "Official PREP and certified results for federal elections.",
     "Open government data",
     "PREP updates every minutes on election night; certification weeks later.",
     "High",
     "Near-real-time PREP feed available; documentation in Spanish and may require scraping."),
    ("Mexico", "national",
     "Bloomberg Línea Mexico Elections Tracker",
     "https://www.bloomberglinea.com/elecciones-mexico/",
     "Media-run tracker with visualization and projections.",
     "Open web",
     "Minutes on election night.",
     "Medium",
     "Useful backup feed; HTML structure subject to change."),
    ("Brazil", "national",
     "Tribunal Superior Eleitoral (TSE) Results Portal",
     "https://resultados.tse.jus.br/oficial/app/index.html",
     "Official election results for presidential, gubernatorial, and legislative races.",
     "Open government data",
     "Near real-time on election night.",
     "High",
     "Robust official feed with public API endpoints; documentation in Portuguese."),
    ("Brazil", "national",
     "Folha/UOL Real-Time Election Coverage",
     "https://temas.folha.uol.com.br/eleicoes/",
     "Major media outlet providing supplementary context and turnout tracking.",
     "Open web",
     "Minutes.",
     "Medium",
     "Good redundancy but requires HTML parsing; consider language support."),
    ("India", "national",
     "Election Commission of India – Election Results",
     "https://results.eci.gov.in/",
     "Official results portal for Lok Sabha and Assembly elections.",
     "Open government data",
     "Minutes during counting days; final certification after canvass.",
     "High",
     "Structured data with JSON endpoints; uptime maintained during counting."),
    ("India", "national",
     "PRS Legislative Research Election Atlas",
     "https://prsindia.org/elections",
     "Aggregated results with historical comparisons.",
     "Open research use",
     "Days after results",
     "Medium",
     "Excellent for retrospective analysis; not real-time."),
    ("Australia", "national",
     "Australian Electoral Commission Tally Room",
     "https://tallyroom.aec.gov.au/",
     "Official results for federal elections and referendums.",
     "Open government data",
     "Minutes during counts; certification after preference distribution.",
     "High",
     "Reliable JSON endpoints; timezone considerations for automation."),
    ("Australia", "national",
     "ABC News Elections Coverage",
     "https://www.abc.net.au/news/elections/",
     "Live race calls and swing analysis.",
     "Open web",
     "Minutes during election night.",
     "Medium",
     "Good context and alternative feed; scraping or manual export required."),
)

# ---------------------------------------------------------------------------
# FIXED VALUES — source templates for US states and other jurisdictions.
# "{name}" is replaced by the state / jurisdiction name, "{slug}" by the name
# with spaces replaced by underscores. Fields as in COUNTRY_SOURCE_LIBRARY.
# ---------------------------------------------------------------------------

STATE_OFFICE_SOURCE = (
    "{name} election office",
    None,  # the state's official site
    "Certified statewide and county results plus candidate filings.",
    "Official (open web)",
    "Nightly during canvass; certification per statutory calendar.",
    "High",
    "Authoritative counts with predictable publication cadence; may require PDF/CSV parsing.",
)
STATE_DIRECTORY_SOURCE = (
    "{name} election authority (via NASS directory)",
    "https://www.nass.org/can-i-vote",
    "Official portal linking to state-managed election offices.",
    "Open web",
    "Updated each cycle as offices publish new info.",
    "Medium",
    "One-click path to official data even if direct link unknown; manual navigation required.",
)
STATE_ENCYCLOPEDIA_SOURCE = (
    "Ballotpedia – {name} elections portal",
    "https://ballotpedia.org/{slug}",
    "Aggregated election calendars, candidate rosters, and unofficial vote tallies.",
    "Open web (CC BY-SA)",
    "Daily during election periods; slower off-cycle.",
    "Medium",
    "Rich historical context; manual scraping necessary for automated ingestion.",
)
STATE_RESULTS_FEED_SOURCE = (
    "Decision Desk HQ Results Feed",
    "https://results.decisiondeskhq.com/",
    "Paid API for precinct and county level tallies across US states.",
    "Commercial API",
    "Minutes on election night; hourly thereafter.",
    "High",
    "Fast and structured but gated behind subscription and integration work.",
)
GENERIC_WIRE_SOURCE = (
    "Reuters Elections Coverage – {name}",
    "https://www.reuters.com/world/",
    "Global wire-service election reporting with near-real-time updates.",
    "Open web",
    "Minutes during major elections.",
    "Medium",
    "Reliable narrative coverage; data extraction requires scraping and manual QA.",
)
GENERIC_LOCAL_SOURCE = (
    "Local election commission ({name})",
    "",
    "Official jurisdiction election authority (URL to be verified per contest).",
    "Varies",
    "Certification timeline defined by statute.",
    "Low",
    "Research required to identify authoritative feed; placeholder for analyst follow-up.",
)

FEASIBILITY_ORDER = (("Low", 1), ("Medium", 2), ("High", 3))
NO_SOURCES_FEASIBILITY = ("Unknown", "No documented sources; manual research required.")

# ---------------------------------------------------------------------------
# FIXED VALUES — person-name filters
# ---------------------------------------------------------------------------

NAME_TOKEN_PATTERN = r"[A-Za-z][A-Za-z'.-]*"
PERSON_SUFFIX_TOKENS = ("jr", "sr", "ii", "iii", "iv", "v")
PERSON_EXCLUSION_TOKENS = (
    "all", "america", "american", "americans", "beautiful", "big", "bill", "breaking",
    "assembly", "australia", "ballot", "campaign", "caucus", "city", "control", "congress",
    "congressional", "delegates", "democrat", "democrats", "democratic", "election",
    "elections", "federal", "general", "global", "government", "gov", "governor",
    "gubernatorial", "house", "incumbent", "mentions", "mayor", "minister", "news",
    "nomination", "nominee", "nyc", "party", "parliament", "politics", "press", "president",
    "presidency", "primary", "referendum", "representative", "runoff", "senate", "senator",
    "shutdown", "state", "states", "united", "vote", "voter", "voting", "world",
)
# characters stripped from both ends of a found name
NAME_EDGE_CHARACTERS = ".,;:\"'()[]{}"

# ---------------------------------------------------------------------------
# FIXED VALUES — market -> candidate linkage
# ---------------------------------------------------------------------------

OFFICE_FILTER_CODES = (("president", "p"), ("senate", "s"), ("house", "h"))
EMPTY_NAME_MARKERS = ("nan", "none", "null")


# Usual places of the Schedule A files and their header.
SCHEDULE_A_FOLDERS = ("schedule_a", "scheduleA")
SCHEDULE_A_HEADER_FILES = ("indiv_header.csv", "schedule_a_header.csv")

# Bulk column -> table column of the dimension tables.
CANDIDATE_COLUMNS = (
    ("CAND_ID", "cand_id"), ("cycle", "cycle"), ("CAND_NAME", "display_name"),
    ("CAND_PTY_AFFILIATION", "party"), ("CAND_OFFICE", "office"), ("CAND_OFFICE_ST", "state"),
    ("CAND_OFFICE_DISTRICT", "district"), ("CAND_ELECTION_YR", "candidate_election_year"),
    ("CAND_ICI", "incumbent_challenger_status"), ("CAND_STATUS", "status"),
    ("CAND_PCC", "principal_campaign_committee"),
)
COMMITTEE_COLUMNS = (
    ("CMTE_ID", "cmte_id"), ("cycle", "cycle"), ("CMTE_NM", "name"), ("TRES_NM", "treasurer"),
    ("CMTE_ST1", "street_1"), ("CMTE_ST2", "street_2"), ("CMTE_CITY", "city"), ("CMTE_ST", "state"),
    ("CMTE_ZIP", "zip"), ("CMTE_DSGN", "designation"), ("CMTE_TP", "committee_type"),
    ("CMTE_PTY_AFFILIATION", "party_affiliation"), ("CMTE_FILING_FREQ", "filing_frequency"),
    ("ORG_TP", "org_type"), ("CONNECTED_ORG_NM", "connected_org"), ("CAND_ID", "principal_candidate_id"),
)
LINKAGE_COLUMNS = (
    ("CAND_ID", "cand_id"), ("CMTE_ID", "cmte_id"), ("cycle", "cycle"),
    ("CMTE_TP", "committee_type_code"), ("CMTE_DSGN", "designation_code"),
)
NAME_PART_COLUMNS = ("first_name", "middle_name", "last_name", "prefix", "suffix")

# --- fixed column lists of the receipts warehouse ---

# receipt column <- dimension column, when the receipt's own value is NULL
CANDIDATE_BACKFILL = (
    ("candidate_name", "display_name"),
    ("candidate_first_name", "first_name"),
    ("candidate_last_name", "last_name"),
    ("candidate_middle_name", "middle_name"),
    ("candidate_prefix", "prefix"),
    ("candidate_suffix", "suffix"),
    ("candidate_office", "office"),
    ("candidate_office_state", "state"),
    ("candidate_office_district", "district"),
)

COMMITTEE_BACKFILL = (
    ("recipient_committee_type", "committee_type"),
    ("recipient_committee_org_type", "org_type"),
    ("recipient_committee_designation", "designation"),
)

# canonical columns the flat-receipt job reads; absent ones are added as NULL (Q3)
REQUIRED_RECEIPT_COLUMNS = (
    "committee_id", "candidate_id", "entity_type", "contributor_name",
    "contribution_receipt_amount", "contribution_receipt_date", "report_year", "report_type",
    "recipient_committee_type", "recipient_committee_org_type", "recipient_committee_designation",
    "candidate_name", "candidate_first_name", "candidate_last_name", "candidate_middle_name",
    "candidate_prefix", "candidate_suffix", "candidate_office", "candidate_office_state",
    "candidate_office_district", "sub_id",
)

WAREHOUSE_TABLES = (
    "candidate_dim",
    "committee_dim",
    "candidate_committees",
    "candidate_cycle_summary",
    "candidate_committee_details",
    "top_contributors",
    "schedule_a_flat",
)
