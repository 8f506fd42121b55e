"""Stand-in domain tables built from the driver's test tables.

The test data is a TPC-H-like star schema, not campaign-finance files, so
each domain table is derived from it by a fixed role mapping (SURVEY §8):

* receipt     = lineitem joined to its order
* candidate   = customer (or the customer's nation where more receipts per
                candidate are wanted)
* committee   = supplier
* contributor = part key, entity type from the return flag
  (A -> IND, R -> COM, N -> PTY)
* amount      = l_extendedprice; cycle = order year rounded up to even
* report year = ship year, report type = line status

Everything here is lazy DataFrame work over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.writers import published, shared_folder  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cycle_of(ts: Column) -> Column:
    """Two-year cycle: the even year at or after the date's year."""
    y = F.year(ts)
    return (y + y % 2).cast("int")


def entity_type_of(flag: Column) -> Column:
    return (
        F.when(flag == "A", F.lit("IND"))
        .when(flag == "R", F.lit("COM"))
        .when(flag == "N", F.lit("PTY"))
    )


def receipts(spark: SparkSession, sf_dir: str, candidate: str = "customer") -> DataFrame:
    """Flat receipts in the ``schedule_a_flat`` column names.

    ``candidate='customer'`` attributes a receipt to the ordering customer,
    ``'nation'`` to that customer's nation."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = li.join(orders, li.l_orderkey == orders.o_orderkey)
    if candidate == "nation":
        cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        joined = joined.join(cust, joined.o_custkey == cust.c_custkey)
        cand = F.col("c_nationkey").cast("long")
    else:
        cand = F.col("o_custkey")
    return joined.select(
        cand.alias("candidate_id"),
        F.col("l_suppkey").alias("committee_id"),
        cycle_of(F.col("o_orderdate")).alias("two_year_transaction_period"),
        F.year("l_shipdate").cast("int").alias("report_year"),
        F.col("l_linestatus").alias("report_type"),
        F.col("l_partkey").cast("string").alias("contributor_name"),
        entity_type_of(F.col("l_returnflag")).alias("entity_type"),
        F.col("l_extendedprice").alias("contribution_receipt_amount"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("contribution_receipt_date"),
        F.col("l_orderkey"),
    )


def raw_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw Schedule A stand-in: receipts before any dimension join.

    Committee contributions (entity COM) name their candidate themselves;
    all other receipts leave ``candidate_id`` empty, like individual
    contributions in the bulk files."""
    r = receipts(spark, sf_dir)
    return r.select(
        F.col("committee_id"),
        F.when(F.col("entity_type") == "COM", F.col("candidate_id")).alias("candidate_id"),
        "entity_type",
        "contributor_name",
        F.col("contribution_receipt_amount").cast("string").alias("contribution_receipt_amount"),
        "contribution_receipt_date",
        "report_year",
        "report_type",
        "two_year_transaction_period",
        F.lit(None).cast("string").alias("candidate_name"),
        *[
            F.lit(None).cast("string").alias(c)
            for c in (
                "candidate_first_name", "candidate_last_name", "candidate_middle_name", "candidate_prefix",
                "candidate_suffix", "candidate_office", "candidate_office_state", "candidate_office_district",
                "recipient_committee_type", "recipient_committee_org_type", "recipient_committee_designation",
            )
        ],
    )


def candidate_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate master stand-in: one row per order, so a (candidate, cycle)
    appears once per order and the dimension has to deduplicate.

    Columns follow the bulk header names; the name is the customer's."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    j = orders.join(cust, orders.o_custkey == cust.c_custkey).join(
        F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")
    )
    office = F.element_at(F.array(F.lit("P"), F.lit("S"), F.lit("H"), F.lit("X"), F.lit(None)), F.col("n_regionkey") + 1)
    return j.select(
        F.col("o_orderkey"),
        F.col("o_custkey").alias("CAND_ID"),
        cycle_of(F.col("o_orderdate")).alias("cycle"),
        F.col("c_name").alias("CAND_NAME"),
        F.col("c_mktsegment").alias("CAND_PTY_AFFILIATION"),
        office.alias("CAND_OFFICE"),
        F.col("n_name").alias("CAND_OFFICE_ST"),
        F.col("o_orderstatus").alias("CAND_OFFICE_DISTRICT"),
        F.year("o_orderdate").cast("string").alias("CAND_ELECTION_YR"),
        F.col("o_orderstatus").alias("CAND_ICI"),
        F.col("o_orderstatus").alias("CAND_STATUS"),
        F.lit(None).cast("string").alias("CAND_PCC"),
    )


def committee_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The (committee, cycle) pairs that have receipts: the one aggregation
    both the link and the committee stand-ins derive from. Each map task sends
    a pair once, so it stays as small as the committees are."""
    return receipts(spark, sf_dir).select("committee_id", "two_year_transaction_period").distinct()


def candidate_links(spark: SparkSession, sf_dir: str, cycles: DataFrame | None = None) -> DataFrame:
    """Linkage stand-in: a committee is linked, in each cycle it has receipts
    in, to two fixed customers: the one with its own key is the principal
    (designation P), the one with twice its key plus one a joint-fundraising
    link (J). Two links per committee and cycle by construction; none is cut."""
    base = cycles if cycles is not None else committee_cycles(spark, sf_dir)
    committees = base.select(F.col("committee_id").alias("CMTE_ID"), F.col("two_year_transaction_period").alias("cycle"))
    link = lambda key, kind, role: F.struct(
        key.cast("long").alias("CAND_ID"), F.lit(kind).alias("CMTE_TP"), F.lit(role).alias("CMTE_DSGN"))
    both = F.array(link(F.col("CMTE_ID"), "H", "P"), link(F.col("CMTE_ID") * 2 + 1, None, "J"))
    rows = committees.select("CMTE_ID", "cycle", F.explode(both).alias("link"))
    return rows.select("link.CAND_ID", "CMTE_ID", "cycle", "link.CMTE_TP", "link.CMTE_DSGN")


def committee_master(spark: SparkSession, sf_dir: str, cycles: DataFrame | None = None) -> DataFrame:
    """Committee master stand-in: a supplier in each cycle it has receipts."""
    r = cycles if cycles is not None else committee_cycles(spark, sf_dir)
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    j = r.join(sup, r.committee_id == sup.s_suppkey)
    typ = F.when(F.col("s_nationkey") % 3 == 0, F.lit("N")).when(F.col("s_nationkey") % 3 == 1, F.lit("Q"))
    return j.select(
        F.col("s_suppkey").alias("CMTE_ID"),
        F.col("two_year_transaction_period").alias("cycle"),
        F.col("s_name").alias("CMTE_NM"),
        *[F.lit(None).cast("string").alias(c) for c in ("TRES_NM", "CMTE_ST1", "CMTE_ST2", "CMTE_CITY")],
        F.col("s_nationkey").cast("string").alias("CMTE_ST"),
        F.lit(None).cast("string").alias("CMTE_ZIP"),
        F.when(F.col("s_nationkey") % 2 == 0, F.lit("U")).alias("CMTE_DSGN"),
        typ.alias("CMTE_TP"),
        *[F.lit(None).cast("string").alias(c) for c in ("CMTE_PTY_AFFILIATION", "CMTE_FILING_FREQ")],
        F.lit("C").alias("ORG_TP"),
        F.lit(None).cast("string").alias("CONNECTED_ORG_NM"),
        F.lit(None).cast("long").alias("CAND_ID"),
    )


def part_candidate_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate master stand-in with person-like names built from part names.

    ``p_name`` is two lower-case words; the size picks one of five name
    layouts, so every C3 branch is exercised (comma form, title prefix,
    plain form, generation suffix, extra comma part). One row per part."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    words = F.split(F.col("p_name"), " ")
    w1, w2 = F.get(words, 0), F.get(words, 1)
    u1, u2 = F.upper(w1), F.upper(w2)
    v = F.col("p_size") % 5
    name = (
        F.when(v == 0, F.concat(u2, F.lit(", "), u1))
        .when(v == 1, F.concat(u2, F.lit(", DR "), u1, F.lit(" "), F.col("p_type")))
        .when(v == 2, F.concat(w1, F.lit("  "), w2))
        .when(v == 3, F.concat(u2, F.lit(", "), u1, F.lit(" Q JR")))
        .otherwise(F.concat(u2, F.lit(","), u1, F.lit(", III")))
    )
    cycle = (F.lit(1994) + F.lit(2) * (F.col("p_size") % 4)).cast("int")
    office = F.element_at(F.array(F.lit("P"), F.lit("S"), F.lit("H"), F.lit(None)), (F.col("p_size") % 4) + 1)
    year = F.when(F.col("p_size") % 7 == 0, F.lit(None)).otherwise(
        (F.lit(1994) + F.lit(2) * (F.col("p_size") % 4) + (F.col("p_size") % 3) * 2).cast("string")
    )
    return part.select(
        F.col("p_partkey").alias("CAND_ID"),
        cycle.alias("cycle"),
        name.alias("CAND_NAME"),
        F.col("p_brand").alias("CAND_PTY_AFFILIATION"),
        office.alias("CAND_OFFICE"),
        F.col("p_type").alias("CAND_OFFICE_ST"),
        F.lpad((F.col("p_size") % 10).cast("string"), 2, "0").alias("CAND_OFFICE_DISTRICT"),
        year.alias("CAND_ELECTION_YR"),
        F.lit("C").alias("CAND_ICI"),
        F.lit("N").alias("CAND_STATUS"),
        F.lit(None).cast("string").alias("CAND_PCC"),
    )


# --- prediction-market stand-ins ---------------------------------------------
#
# market event = a conversation; its markets = the conversation's turns.
# Phrases are prefixed to the whole turn texts so the election filters and
# classifiers have something to find (the generated prose has no election
# vocabulary); which phrase a row gets follows from its ids.

MARKET_PHRASES = (
    "Will X win?", "Winter storm?", "D-nom?", "Household income", "vice president debate",
    "VP pick", "state senate", "state house", "lieutenant governor", "European Parliament",
    "White House", "councilmember", "attorney general", "Pennsylvania primary",
    "West Virginia primary", "PA-07 race", "Who wins in the Senate", "Who is up\nSenate",
    "U.S. Senate control", "Ukraine vote", "Jerusalem vote", "Scotland vote", "Mayor: London",
    "Mayor: New York", "parliament vote", "Will Donald Trump be elected president?",
    "Kamala Harris nominee", "Texas governor runoff", "prime minister majority", "no match here",
)
OUTCOME_TEXTS = ('["Yes", "No"]', "['Yes','No']", '["A","B","C"]', "oops")
PRICE_TEXTS = ('["0","1"]', '["0.85","0.15"]', '["0.5","0.5"]', '["1"]', '["x","1"]', '["0.9","0.95","0.1"]')
TAG_TEXTS = ('["Election","Politics"]', "President, Senate", '["sports"]', "NFL", None, '[" Mayor ", "NBA"]')


def _pick(options, index: Column) -> Column:
    arr = F.array(*[F.lit(o) for o in options])
    return F.element_at(arr, (index % len(options)).cast("int") + 1)


def _iso_spelling(day: Column, variant: Column) -> Column:
    """A date rendered in one of several ISO-like spellings (or junk)."""
    d = F.date_format(day, "yyyy-MM-dd")
    return (
        F.when(variant == 0, F.concat(d, F.lit("T12:00:00Z")))
        .when(variant == 1, F.concat(d, F.lit(" 08:30:00+00")))
        .when(variant == 2, F.concat(d, F.lit("T20:15:00-05:00")))
        .when(variant == 3, d)
        .when(variant == 4, F.lit("junk"))
        .otherwise(F.lit(""))
    )


def market_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested market events (EVENT_SCHEMA shape) built from conversations:
    an event per conversation, its markets the turns."""
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    cid, turn = F.col("conv_id"), F.col("turn")
    market = F.struct(
        (cid * 1000 + turn).cast("string").alias("id"),
        F.concat(_pick(MARKET_PHRASES, cid + turn), F.lit(" "), F.col("text")).alias("question"),
        F.when(F.col("role") == "assistant", F.lit("")).when(F.col("role") == "system", F.lit(None))
        .otherwise(F.col("text")).alias("description"),
        _pick(OUTCOME_TEXTS, turn).alias("outcomes"),
        _pick(PRICE_TEXTS, cid + turn).alias("outcomePrices"),
        F.concat(F.lit('["t'), cid.cast("string"), F.lit('", "u'), turn.cast("string"), F.lit('"]')).alias("clobTokenIds"),
        F.when(turn % 3 == 0, F.lit(None)).when(turn % 3 == 1, F.lit(""))
        .otherwise(_iso_spelling(F.date_add(F.lit("2021-01-01").cast("date"), (cid * 7 + turn).cast("int")), turn % 4))
        .alias("closedTime"),
        F.when(F.col("role") == "user", F.lit("")).otherwise(F.concat(F.lit("src-"), F.col("role"))).alias("resolutionSource"),
        F.length("text").cast("string").alias("volume"),
        F.when(turn % 2 == 0, F.lit("null")).otherwise((turn * 1.5).cast("string")).alias("volume24hr"),
        F.lit(None).cast("string").alias("volume1wk"),
        F.concat(turn.cast("string"), F.lit("_000")).alias("volume1mo"),
        F.lit("1.0d").alias("volume1yr"),
        F.concat(F.lit(" "), (turn + 1).cast("string"), F.lit(" ")).alias("liquidity"),
        F.when(turn % 3 == 0, F.lit("0")).otherwise(turn.cast("string")).alias("liquidityAmm"),
    )
    # per-conversation event fields: partial aggregates, one row per event
    per_event = conv.groupBy("conv_id").agg(
        F.min_by("text", "turn").alias("first_text"),
        F.max_by("text", "turn").alias("last_text"),
        F.min_by("role", "turn").alias("first_role"),
        F.count(F.lit(1)).alias("n_turns"),
    )
    # every turn lands as its own page entry of the event (same event id,
    # one market each), so no group is ever collected into one row
    pages = conv.select("conv_id", F.array(market).alias("markets")).join(per_event, "conv_id")
    day = F.date_add(F.lit("2021-01-01").cast("date"), (F.col("conv_id") * 7).cast("int"))
    cid = F.col("conv_id")
    return pages.select(
        cid.cast("string").alias("id"),
        F.concat(_pick(MARKET_PHRASES, cid * 7), F.lit(" "), F.col("first_text")).alias("title"),
        F.col("last_text").alias("description"),
        F.lit(None).cast("string").alias("ticker"),
        F.concat(F.lit("conv-"), cid.cast("string")).alias("slug"),
        F.col("first_role").alias("category"),
        _iso_spelling(F.date_sub(day, 30), cid % 6).alias("startDate"),
        _iso_spelling(day, (cid + 1) % 6).alias("endDate"),
        _iso_spelling(F.date_add(day, 1), (cid + 2) % 6).alias("closedTime"),
        F.concat(F.lit("event-src-"), cid.cast("string")).alias("resolutionSource"),
        (F.col("n_turns") * 10).cast("string").alias("liquidityClob"),
        F.lit("5").alias("liquidityAmm"),
        F.when(cid % 2 == 0, F.lit("12.5")).otherwise(F.lit("null")).alias("openInterest"),
        F.col("markets"),
    )


def analytics_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analytics snapshot entries (ANALYTICS_FIELDS + _file/_pos) from the
    event stream: entry market id = user_id * 1000 + event_id % 8, so each
    market gets a series of entries in time order and the latest wins."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    tags = (
        F.when(F.col("event_type") == "click", F.lit(TAG_TEXTS[0]))
        .when(F.col("event_type") == "view", F.lit(TAG_TEXTS[1]))
        .when(F.col("event_type") == "error", F.lit(TAG_TEXTS[2]))
        .when(F.col("event_type") == "signup", F.lit(TAG_TEXTS[5]))
    )
    return ev.select(
        F.lit("snapshot").alias("_file"),
        F.col("event_id").alias("_pos"),
        (F.col("user_id") * 1000 + F.col("event_id") % 8).cast("string").alias("market_id"),
        F.col("value").cast("string").alias("market_volume"),
        F.get_json_object("props", "$.k").alias("market_open_interest"),
        (F.col("value") / 100).cast("string").alias("outcome_1_price"),
        F.lit(None).cast("string").alias("outcome_2_price"),
        F.col("event_type").alias("event_slug"),
        F.lit("analytics").alias("source"),
        tags.alias("event_tags"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("market_close_date"),
        F.lit(None).cast("string").alias("event_end_date"),
        F.when(F.col("event_type") == "purchase", F.lit("Ohio senate special")).alias("event_title"),
        F.lit(None).cast("string").alias("event_description"),
    )


def person_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name): persons to look for in market texts: the first two words of
    every second turn, in small letters."""
    turns = table(spark, sf_dir, "conversations").where("turn % 2 = 0").select("text")
    name = F.lower(F.regexp_extract("text", r"^(\p{L}+ \p{L}+)", 1))
    return turns.select(name.alias("name")).where("name <> ''").distinct()


def analytics_pages(spark: SparkSession, sf_dir: str, page_entries: int = 500) -> DataFrame:
    """(page, value): the analytics entries as fetched pages, each one JSON
    document of at most ``page_entries`` entries, in order."""
    entries = analytics_entries(spark, sf_dir)
    fields = [c for c in entries.columns if not c.startswith("_")]
    entry = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    page = F.floor(F.col("_pos") / page_entries).alias("page")
    listed = entries.select(page, F.struct("_pos", entry.alias("entry")).alias("e")).groupBy("page").agg(F.sort_array(F.collect_list("e")).alias("es"))
    return listed.select("page", F.concat(F.lit('{"data": ['), F.array_join(F.transform("es", lambda e: e["entry"]), ", "), F.lit("]}")).alias("value"))


def link_markets_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markets for the linkage job: one per distinct part name.

    candidate_names lists the name as written and reversed; office and the
    start/end dates follow from the sizes of the parts with that name."""
    part = table(spark, sf_dir, "part").select("p_name", "p_size")
    g = part.groupBy("p_name").agg(F.min("p_size").alias("smin"), F.max("p_size").alias("smax"))
    words = F.split(F.col("p_name"), " ")
    w1, w2 = F.get(words, 0), F.get(words, 1)
    names = (
        F.when(F.col("smin") % 4 == 0, F.initcap(F.col("p_name")))
        .when(F.col("smin") % 4 == 1, F.concat(F.initcap(F.col("p_name")), F.lit(", "), F.initcap(F.concat(w2, F.lit(" "), w1))))
        .when(F.col("smin") % 4 == 2, F.concat(F.upper(w2), F.lit(" | "), F.initcap(w1), F.lit(" "), F.initcap(w2)))
        .otherwise(F.lit("nan"))
    )
    office = F.element_at(
        F.array(F.lit("President"), F.lit("senate"), F.lit("House"), F.lit("Governor"), F.lit(None)),
        (F.col("smax") % 5) + 1,
    )
    start = F.when(F.col("smin") % 3 == 0, F.lit(None)).otherwise(
        F.concat((F.lit(1994) + (F.col("smin") % 3) * 2).cast("string"), F.lit("-01-01")))
    end = F.when(F.col("smax") % 4 == 0, F.lit(None)).otherwise(
        F.concat((F.lit(1996) + (F.col("smax") % 3) * 2).cast("string"), F.lit("-12-31")))
    return g.select(
        F.col("p_name").alias("market_id"), names.alias("candidate_names"), office.alias("office"),
        start.alias("start_date"), end.alias("end_date"),
    )


def bulk_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts with raw bulk-file column names (upper case, FEC short forms),
    including two sources for one canonical name (NAME, CONTBR_NM)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus",
        "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    j = li.join(orders, li.l_orderkey == orders.o_orderkey)
    return j.select(
        F.col("l_suppkey").cast("string").alias("CMTE_ID"),
        F.col("l_partkey").cast("string").alias("NAME"),
        F.col("o_orderpriority").alias("CONTBR_NM"),
        F.date_format("l_shipdate", "MMddyyyy").alias("TRANSACTION_DT"),
        F.col("l_extendedprice").cast("string").alias("TRANSACTION_AMT"),
        F.col("l_returnflag").alias("ENTITY_TP"),
        F.col("l_linestatus").alias("RPT_TP"),
        F.year("l_shipdate").cast("string").alias("Rpt_Yr"),
        F.col("o_custkey").cast("string").alias("CAND_ID"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("TRAN_ID"),
        F.when(F.col("l_returnflag") == "R", F.lit("X")).alias("MEMO_CD"),
    )


NUMBER_SPELLINGS = 8


def number_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric text in the spellings the market API mixes (plain, padded,
    'null', empty, junk suffix, digit separator, 'inf', Java type suffix) and
    integer text (plain, '.0', padded, junk), chosen by event id."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    v = F.col("value").cast("string")
    k = F.col("event_id") % NUMBER_SPELLINGS
    txt = (
        F.when(k == 0, v).when(k == 1, F.concat(F.lit(" "), v, F.lit(" "))).when(k == 2, F.lit("null"))
        .when(k == 3, F.lit("")).when(k == 4, F.concat(v, F.lit("abc")))
        .when(k == 5, F.regexp_replace(v, r"\.", "_")).when(k == 6, F.lit("inf"))
        .otherwise(F.concat(v, F.lit("d")))
    )
    u = F.col("user_id").cast("string")
    i = F.col("event_id") % 4
    int_txt = F.when(i == 0, u).when(i == 1, F.concat(u, F.lit(".0"))).when(i == 2, F.concat(F.lit(" "), u)).otherwise(F.lit("x"))
    return ev.select("event_id", txt.alias("number_text"), int_txt.alias("int_text"))


