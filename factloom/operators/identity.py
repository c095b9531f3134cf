"""Who a filer is: profiles, tickers, cohorts, producers, listing, and issuers that are one."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.names import base_form, company_name
from factloom.registry import NON_OPERATOR_HINTS, NON_OPERATOR_SIC, NON_PRODUCING_SIC, SIC_COHORTS

# Annual forms, forms that end a registration, phrases and the count of them that make a producer.
ANNUAL_FORMS = ("10-K", "20-F", "40-F")
PERIODIC_FORMS = ("10-K", "10-Q", "20-F", "40-F")
DEREGISTRATION_FORMS = ("15-12B", "15-12G", "15F-12B", "15F-12G")
DERIVATIVE_SUFFIXES = ("-WT", "-WS", "-RT", "-U", "-UN")
PHRASE_HITS = 5
WRAPPERS = ("40-F", "6-K", "8-K")


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(values.items())])


def cohort_of(sic: Column, description: Column, override: Column | None = None) -> tuple[Column, Column]:
    """(cohort, where it comes from or why there is none)."""
    by_sic, idle = _map(SIC_COHORTS)[sic], _map(NON_PRODUCING_SIC)[sic]
    own = F.lit(None).cast("string") if override is None else override
    reason = (
        F.when(own.isNotNull(), "sic-override").when(by_sic.isNotNull(), "sic")
        .when(idle.isNotNull(), F.concat(F.lit("SIC "), sic, F.lit(" "), idle, F.lit(": holds no reserves")))
        .otherwise(F.concat(F.lit("SIC "), F.coalesce(F.nullif(sic, F.lit("")), F.lit("?")), F.lit(" "), F.coalesce(F.nullif(description, F.lit("")), F.lit("unclassified"))))
    )
    return F.coalesce(own, by_sic), reason


def is_operator(sic: Column, name: Column, hints: tuple[str, ...] = NON_OPERATOR_HINTS) -> Column:
    """False for royalty traders by code and for names that say royalties, minerals or trust."""
    hinted = reduce(lambda a, b: a | b, [F.contains(F.lower(name), F.lit(h)) for h in hints])
    return ~(F.coalesce(sic.isin(*NON_OPERATOR_SIC), F.lit(False)) | F.coalesce(hinted, F.lit(False)))


def derivative_ticker(ticker: Column) -> Column:
    """Warrants, units and rights: a suffix that says so, or five letters ending in W, R or U."""
    upper = F.upper(ticker)
    suffixed = reduce(lambda a, b: a | b, [F.endswith(upper, F.lit(x)) for x in DERIVATIVE_SUFFIXES])
    return suffixed | upper.rlike("^.{4}[WRU]$")


def primary_ticker(tickers: Column) -> Column:
    """The shortest, then first, ticker that is no derivative; of derivatives alone the shortest of them."""
    plain = F.filter(tickers, lambda t: ~derivative_ticker(t))
    pool = F.when(F.size(plain) > 0, plain).otherwise(tickers)
    return F.array_min(F.transform(pool, lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))))["t"]


def domicile(state: Column, state_name: Column, incorporation: Column, incorporation_name: Column) -> tuple[Column, Column]:
    """(is foreign, country). A state of the union describes itself by its own code; the address decides, and
    incorporation only where there is none, which never makes a filer domestic by country."""
    given, other = F.coalesce(state, F.lit("")) != "", F.coalesce(incorporation, F.lit("")) != ""
    bare = lambda name: F.trim(F.substring_index(name, ",", -1))
    abroad, founded = ~state.eqNullSafe(state_name), ~incorporation.eqNullSafe(incorporation_name)
    foreign = F.when(given, abroad).when(other, founded).otherwise(False)
    return foreign, F.when(given, F.when(abroad, bare(state_name)).otherwise("USA")).when(other & founded, bare(incorporation_name))


def reporting_taxonomy(us_gaap: Column, ifrs: Column) -> Column:
    """The namespace with more tags; a tie goes to the first; none of either is unknown."""
    return F.when((us_gaap == 0) & (ifrs == 0), "unknown").when(us_gaap >= ifrs, "us-gaap").otherwise("ifrs-full")


def annual_form(filings: DataFrame) -> DataFrame:
    """(cik, annual_form, regime): the most frequent base form among annual ones, ties by the first seen."""
    rows = filings.withColumn("base", base_form(F.col("form"))).where(F.col("base").isin(*ANNUAL_FORMS))
    counts = rows.groupBy("cik", "base").agg(F.count("*").alias("n"), F.min("ordinal").alias("seen"))
    best = counts.groupBy("cik").agg(F.max_by("base", F.struct(F.col("n"), -F.col("seen"))).alias("annual_form"))
    return best.withColumn("regime", F.when(F.col("annual_form") == "40-F", "ni-51-101").otherwise("subpart-1200"))


def producer_verdict(concepts: Column, hits: Column, documents: Column) -> Column:
    """Tagged reserves make a producer, as do enough phrases; nothing read leaves it unknown."""
    return F.when(concepts > 0, "producer").when(F.coalesce(hits, F.lit(0)) >= PHRASE_HITS, "producer").when(F.coalesce(documents, F.lit(0)) == 0, "unknown").otherwise("non-producer")


def listing_status(filings: DataFrame, tickers: DataFrame, superseded: DataFrame) -> DataFrame:
    """(cik, listing_status, last_filing_date): superseded, then listed, then deregistered unless a periodic report
    followed, else a private filer."""
    last = lambda forms: F.max(F.when(base_form(F.col("form")).isin(*forms), F.col("filed_date")))
    history = filings.groupBy("cik").agg(F.max("filed_date").alias("last_filing_date"), last(PERIODIC_FORMS).alias("periodic"), last(DEREGISTRATION_FORMS).alias("gone"))
    flag = lambda df, name: df.select("cik", F.lit(True).alias(name)).distinct()
    rows = history.join(flag(superseded, "superseded"), "cik", "left").join(flag(tickers, "listed"), "cik", "left")
    gone = F.col("gone").isNotNull() & (F.col("periodic").isNull() | (F.col("periodic") <= F.col("gone")))
    status = F.when(F.col("superseded"), "superseded").when(F.col("listed"), "listed").when(gone, "deregistered").otherwise("private-filer")
    return rows.select("cik", status.alias("listing_status"), "last_filing_date")


def admission(candidates: DataFrame) -> DataFrame:
    """decision and reason of each candidate: cik, excluded (reason or null), ticker, cohort, cohort_reason, verdict."""
    reason = (
        F.when(F.col("excluded").isNotNull(), F.col("excluded")).when(F.col("ticker").isNull(), "no listed security")
        .when(F.col("cohort").isNull(), F.col("cohort_reason")).when(F.col("verdict") == "non-producer", "not a producer")
        .when(F.col("verdict").isNull() | (F.col("verdict") == "unknown"), "held: no verdict yet")
    )
    decision = F.when(reason.isNull(), "admitted").when(reason.startswith("held"), "held").otherwise("excluded")
    return candidates.withColumn("reason", reason).withColumn("decision", decision)


def ticker_sync(company: DataFrame, tickers: DataFrame) -> DataFrame:
    """(cik, outcome, old, new): what the map of tickers says of each company."""
    new = tickers.select("cik", F.col("ticker").alias("new"))
    rows = company.select("cik", F.nullif("ticker", F.lit("")).alias("old")).join(new, "cik", "left")
    outcome = F.when(F.col("new").isNull(), F.when(F.col("old").isNull(), "unlisted").otherwise("missing")).when(F.col("old").isNull(), "backfill").when(F.col("old") != F.col("new"), "conflict").otherwise("same")
    return rows.withColumn("outcome", outcome)


def issuer_edges(profiles: DataFrame) -> DataFrame:
    """(a, b) of profiles with a ticker in common, or where one's former name is the other's name.

    profiles: cik, name, tickers, former_names. Each shared key links its members to the smallest of them, so a key of
    n profiles makes n - 1 edges.
    """
    keys = profiles.select("cik", F.explode(F.coalesce("tickers", F.array().cast("array<string>"))).alias("t")).where(F.col("t").isNotNull()).select("cik", F.concat(F.lit("t:"), "t").alias("key"))
    names = profiles.select("cik", F.concat(F.lit("n:"), company_name(F.col("name"))).alias("key"))
    former = profiles.select("cik", F.explode(F.coalesce("former_names", F.array().cast("array<string>"))).alias("n")).select("cik", F.concat(F.lit("n:"), company_name(F.col("n"))).alias("key"))
    # A name alone does not link two filers: one of them must hold it as a former name.
    linked = former.unionByName(names.join(former.select("key").distinct(), "key", "left_semi").select("cik", "key"))
    members = keys.unionByName(linked).where(F.col("key") != "n:").distinct()
    hub = members.groupBy("key").agg(F.min("cik").alias("a"))
    return members.join(hub, "key").where(F.col("cik") != F.col("a")).select("a", F.col("cik").alias("b")).distinct()


def issuer_groups(profiles: DataFrame, save) -> DataFrame:
    """(cik, issuer, primary): issuer is the smallest linked cik; primary the member with the newest annual report,
    then the most of them, then the smallest cik.

    profiles: also latest_annual, annual_count. save(df) must cut the lineage of a round, by checkpoint or a table.
    """
    edges = save(issuer_edges(profiles))
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = save(profiles.select("cik", F.col("cik").alias("issuer")).distinct())
    while True:
        low = both.join(labels, both["b"] == labels["cik"]).groupBy("a").agg(F.min("issuer").alias("low"))
        step = labels.join(low, labels["cik"] == low["a"], "left").select("cik", F.least("issuer", F.coalesce("low", "issuer")).alias("issuer"))
        hop = step.select(F.col("cik").alias("issuer"), F.col("issuer").alias("root"))  # a label's own label: paths halve
        after = save(step.join(hop, "issuer", "left").select("cik", F.least("issuer", F.coalesce("root", "issuer")).alias("issuer")))
        moved = after.join(labels.select("cik", F.col("issuer").alias("was")), "cik").where(F.col("issuer") != F.col("was")).limit(1).count()
        labels = after
        if not moved:
            break
    ranked = profiles.select("cik", "latest_annual", "annual_count").join(labels, "cik")
    order = Window.partitionBy("issuer").orderBy(F.desc_nulls_last("latest_annual"), F.desc_nulls_last("annual_count"), "cik")
    return ranked.withColumn("rn", F.row_number().over(order)).select("cik", "issuer", (F.col("rn") == 1).alias("is_primary"))


def exhibits(items: DataFrame, least_size: int = 4000, most: int = 6) -> DataFrame:
    """Readable EX-99 attachments of a size, the largest few of each filing. items: accession, document, type, size."""
    readable = items.where(F.col("type").startswith("EX-99") & F.lower("document").rlike(r"\.html?$") & (F.col("size") >= least_size))
    order = Window.partitionBy("accession").orderBy(F.desc("size"), "document")
    return readable.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= most)


def is_wrapper(form: Column) -> Column:
    return base_form(form).isin(*WRAPPERS)
