"""Payloads of filers: tagged facts, submissions and the map of tickers, JSON texts read as VARIANT.

Their keys are dynamic (taxonomies, tags, units), so no schema is fixed: objects are opened as maps of variants, level by
level, and a field is taken by its path with the type that it is wanted in. Fields that nobody asks for stay in the
payload, and in an observation's own variant. A text that is no JSON is a row with its error, not a failure of the read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.functions.names import base_form, cik_padded
from factloom.operators.identity import ANNUAL_FORMS, domicile
from factloom.registry import PRODUCT_OF_UNIT, aliases_frame, concepts_frame, units_frame

#: What is asked for of an observation and of submissions, with types; a field of another kind is null.
OBSERVATION = "struct<start:string,end:string,val:double,accn:string,fy:int,fp:string,form:string,filed:string,frame:string>"
SUBMISSIONS = (
    "struct<cik:string,name:string,tickers:array<string>,exchanges:array<string>,sic:string,sicDescription:string,"
    "addresses:struct<business:struct<stateOrCountry:string,stateOrCountryDescription:string>>,stateOfIncorporation:string,stateOfIncorporationDescription:string,"
    "formerNames:array<struct<name:string>>,filings:struct<recent:struct<form:array<string>,filingDate:array<string>,accessionNumber:array<string>,primaryDocument:array<string>,reportDate:array<string>>>>"
)
DEFAULT_FORMS = ("10-K", "10-K/A")
NO_TEXT, MALFORMED, NO_OBJECT = "no text", "malformed JSON", "not an object"


def field(variant: Column | str, path: str, kind: str) -> Column:
    """What a path of a variant holds, in a type; null where it is absent or of another kind."""
    return F.try_variant_get(F.col(variant) if isinstance(variant, str) else variant, path, kind)


def members(variant: Column | str, path: str = "$") -> Column:
    """The object at a path as a map of variants; null where there is none."""
    return field(variant, path, "map<string,variant>")


def parsed(texts: DataFrame, text_col: str) -> DataFrame:
    """texts with the column payload (VARIANT) instead of the JSON text, and error: null, or why there is no payload.
    An object that has a key twice counts as malformed."""
    blank = F.coalesce(F.trim(text_col) == "", F.lit(True))
    read = texts.withColumns({"error": F.when(blank, NO_TEXT), "payload": F.try_parse_json(F.col(text_col))}).drop(text_col)  # parsed once
    error = F.when(F.col("error").isNotNull(), F.col("error")).when(F.col("payload").isNull(), MALFORMED).when(members("payload").isNull(), NO_OBJECT)
    return read.withColumn("error", error).withColumn("payload", F.when(F.col("error").isNull(), F.col("payload")))


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """(source, error, payload): one row a JSON file of the folder that has any text."""
    texts = spark.read.text(folder, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("source"), "value")
    return parsed(texts, "value")


def failures(payloads: DataFrame) -> DataFrame:
    """(error, n): how many texts gave no payload, by reason."""
    return payloads.where("error is not null").groupBy("error").agg(F.count("*").alias("n"))


def observations(payloads: DataFrame) -> DataFrame:
    """One row an observation: cik, taxonomy, tag, unit, its ordinal in the unit's list, its fields, and the whole of it
    as a variant (`observed`), with what OBSERVATION does not name. A tag without units gives one row of nulls."""
    p = payloads.select(cik_padded(field("payload", "$.cik", "string")).alias("cik"), F.explode(members("payload", "$.facts")).alias("taxonomy", "tags"))
    p = p.select("cik", "taxonomy", F.explode(members("tags")).alias("tag", "body")).select("cik", "taxonomy", "tag", F.explode_outer(members("body", "$.units")).alias("unit", "list"))
    p = p.select("cik", "taxonomy", "tag", "unit", F.posexplode_outer(field("list", "$", "array<variant>")).alias("ordinal", "observed"))
    return p.withColumn("o", field("observed", "$", OBSERVATION)).select("cik", "taxonomy", "tag", "unit", "ordinal", "o.*", "observed")


def chosen_tags(obs: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """(cik, concept_key, tag): the first alias in the registry's order whose tag is present, under any taxonomy; an
    override (cik, concept_key, tag) beats it."""
    present = obs.select("cik", "taxonomy", "tag").distinct().join(F.broadcast(aliases_frame(obs.sparkSession)), ["taxonomy", "tag"])  # aliases: the registry
    first = present.groupBy("cik", "concept_key").agg(F.min_by("tag", "alias_ord").alias("tag"))
    if overrides is None:
        return first
    given = overrides.select("cik", "concept_key", F.col("tag").alias("given"))
    return first.join(given, ["cik", "concept_key"], "full_outer").select("cik", "concept_key", F.coalesce("given", "tag").alias("tag"))


def fact_rows(obs: DataFrame, forms: tuple[str, ...] | None = DEFAULT_FORMS, overrides: DataFrame | None = None, preferred: DataFrame | None = None) -> DataFrame:
    """Rows of all concepts at once: observations of the chosen tag name under every taxonomy that the registry lists
    for it, that have an end, a value and an accession, in the given forms. preferred: (cik, concept_key, unit) of a
    validated unit, which ranks before all others."""
    spark = obs.sparkSession
    aliases = aliases_frame(spark).select("concept_key", "taxonomy", "tag")
    rows = obs.join(F.broadcast(aliases), ["taxonomy", "tag"]).join(chosen_tags(obs, overrides), ["cik", "concept_key", "tag"], "left_semi")
    rows = rows.where(F.col("end").isNotNull() & F.col("val").isNotNull() & F.col("accn").isNotNull())
    if forms is not None:
        rows = rows.where(F.col("form").isin(*forms))
    rank = units_frame(spark)
    rows = rows.join(F.broadcast(concepts_frame(spark).select("concept_key", "n_units")), "concept_key").join(F.broadcast(rank), ["concept_key", "unit"], "left")
    value = F.coalesce("unit_rank", "n_units")
    if preferred is not None:
        own = preferred.select("cik", "concept_key", "unit", F.lit(-1).alias("validated"))
        rows, value = rows.join(own, ["cik", "concept_key", "unit"], "left"), F.coalesce("validated", "unit_rank", "n_units")
    product = F.create_map(*[F.lit(x) for kv in PRODUCT_OF_UNIT.items() for x in kv])[F.col("unit")]
    out = rows.select(
        "cik", "concept_key", "taxonomy", "tag", F.col("val").alias("value"), "unit", F.col("start").alias("period_start"), F.col("end").alias("period_end"), F.col("fy").alias("fiscal_year"), F.col("fp").alias("fiscal_period"),
        F.col("accn").alias("accession"), "form", F.coalesce("filed", F.lit("")).alias("filed"), product.alias("product"), value.alias("unit_rank"), "frame", F.lit("xbrl").alias("extracted_by"),
        F.coalesce(product, F.lit("")).alias("product_key"), F.coalesce("start", F.lit("")).alias("period_start_key"), "ordinal",
    )
    return out


def in_order(rows: DataFrame) -> DataFrame:
    """Adds seq, the place of a row among its company's: period, product, unit rank, date, accession."""
    order = Window.partitionBy("cik", "concept_key").orderBy("period_end", "product_key", "unit_rank", "filed", "accession", "ordinal", "taxonomy")
    return rows.withColumn("seq", F.row_number().over(order))


def coverage(obs: DataFrame, ciks: DataFrame, forms: tuple[str, ...] | None = None) -> DataFrame:
    """Registry x filers: whether a concept is tagged, how often, in which units, until when. The registry is fixed, so
    the product has a bounded number of rows a filer."""
    rows = fact_rows(obs, forms).groupBy("cik", "concept_key").agg(F.count("*").alias("observations"), F.array_join(F.sort_array(F.collect_set("unit")), "|").alias("units"), F.max("period_end").alias("latest_period"))
    grid = ciks.select("cik").distinct().select("cik", F.explode(F.array(*[F.lit(c) for c in _keys()])).alias("concept_key"))
    return grid.join(rows, ["cik", "concept_key"], "left").select("cik", "concept_key", F.col("observations").isNotNull().alias("tagged"), F.coalesce("observations", F.lit(0)).cast("long").alias("observations"), "units", "latest_period")


def empty_payloads(obs: DataFrame, ciks: DataFrame) -> DataFrame:
    """(cik, error) of filers whose payload holds no observation at all: all their concepts are untagged for that reason."""
    return ciks.select("cik").distinct().join(obs.select("cik").distinct(), "cik", "left_anti").withColumn("error", F.lit("empty payload"))


def _keys() -> list[str]:
    from factloom.registry import CONCEPTS

    return [c.key for c in CONCEPTS]


def filings(payloads: DataFrame) -> DataFrame:
    """One row a filing of the submissions; shorter arrays give nulls."""
    fields = {"form": "form", "filed_date": "filingDate", "accession": "accessionNumber", "primary_doc": "primaryDocument", "period_end": "reportDate"}
    zipped = F.arrays_zip(*[F.coalesce(F.col("s.filings.recent")[f], F.array().cast("array<string>")).alias(n) for n, f in fields.items()])
    return payloads.select(field("payload", "$", SUBMISSIONS).alias("s")).select(cik_padded(F.col("s.cik")).alias("cik"), F.posexplode(zipped).alias("ordinal", "f")).select("cik", "ordinal", "f.*").where(F.col("form").isNotNull())


def profiles(payloads: DataFrame) -> DataFrame:
    """One row a filer: identity, domicile, newest annual report and its form, counts of annual and 8-K filings."""
    listed = lambda name: F.filter(F.coalesce(name, F.array().cast("array<string>")), lambda t: t.isNotNull())
    foreign, country = domicile(F.col("s.addresses.business.stateOrCountry"), F.col("s.addresses.business.stateOrCountryDescription"), F.col("s.stateOfIncorporation"), F.col("s.stateOfIncorporationDescription"))
    names = F.filter(F.transform(F.coalesce("s.formerNames", F.array().cast("array<struct<name:string>>")), lambda x: x["name"]), lambda x: x.isNotNull())
    who = payloads.select(field("payload", "$", SUBMISSIONS).alias("s")).select(
        cik_padded(F.col("s.cik")).alias("cik"), F.col("s.name").alias("name"), listed("s.tickers").alias("tickers"), listed("s.exchanges").alias("exchanges"), F.col("s.sic").alias("sic"), F.col("s.sicDescription").alias("sic_description"),
        names.alias("former_names"), foreign.alias("is_foreign"), country.alias("country"),
    )
    base = base_form(F.col("form"))
    annual, eightk = base.isin(*ANNUAL_FORMS), base == "8-K"
    newest = F.struct("filed_date", "accession")
    counts = filings(payloads).groupBy("cik").agg(
        F.count_if(annual).alias("annual_count"), F.max(F.when(annual, F.col("filed_date"))).alias("latest_annual"), F.max_by(F.when(annual, base), F.when(annual, newest)).alias("annual_form"),
        F.count_if(eightk).alias("eightk_count"), F.max(F.when(eightk, F.col("filed_date"))).alias("latest_8k"),
    )
    return who.join(counts, "cik", "left").na.fill(0, ["annual_count", "eightk_count"])


def profiles_of(ciks: DataFrame, payloads: DataFrame) -> DataFrame:
    """A profile for each company asked for: blank, with an error that says so, where its payload is absent or did not
    parse."""
    found = profiles(payloads.where(F.col("payload").isNotNull())).withColumn("known", F.lit(True))
    rows = ciks.select("cik").distinct().join(found, "cik", "left")
    lists = {c: F.coalesce(c, F.array().cast("array<string>")) for c in ("tickers", "exchanges", "former_names")}
    return rows.withColumns(lists).na.fill(0, ["annual_count", "eightk_count"]).withColumn("error", F.when(F.col("known").isNull(), "no submissions")).drop("known")


def ticker_map(payloads: DataFrame) -> DataFrame:
    """(cik, tickers) of a map keyed by row number, in the order of the rows, each ticker once."""
    rows = payloads.select(F.explode(members("payload")).alias("row", "v")).select(cik_padded(field("v", "$.cik_str", "string")).alias("cik"), F.col("row").cast("int").alias("row"), field("v", "$.ticker", "string").alias("t"))
    listed = F.array_sort(F.collect_list(F.struct("row", "t")))
    return rows.groupBy("cik").agg(F.array_distinct(F.transform(listed, lambda x: x["t"])).alias("tickers"))


def first_tickers(mapped: DataFrame) -> DataFrame:
    """(cik, ticker, n): the first listed ticker of each company, and how many it has."""
    return mapped.select("cik", F.try_element_at("tickers", F.lit(1)).alias("ticker"), F.size("tickers").alias("n"))


def cohort_csv(spark: SparkSession, path: str) -> DataFrame:
    """Candidates of a CSV file with a header: cik, name, tickers (parted by bars), as text; rows without a number go."""
    return spark.read.csv(path, header=True).where(F.col("cik").isNotNull()).withColumn("cik", cik_padded(F.col("cik")))


def revalidated(payloads_: DataFrame, company: DataFrame) -> DataFrame:
    """(status, n): the verdicts of arithmetic over every cached payload of a known company, most frequent first."""
    from factloom.operators.validation import candidate_values, validate_family

    obs = observations(payloads_).join(company.select("cik"), "cik", "left_semi")
    dated = obs.join(F.broadcast(aliases_frame(obs.sparkSession).select("concept_key", "taxonomy", "tag", "alias_ord")), ["taxonomy", "tag"])
    fit = dated.where(F.col("form").isin(*DEFAULT_FORMS) & F.col("end").isNotNull() & F.col("val").isNotNull() & F.col("accn").isNotNull())
    values = candidate_values(fit.select("cik", "concept_key", "tag", "unit", F.col("end").alias("period_end"), "filed", "ordinal", F.col("val").alias("value"), "alias_ord"))
    asked = payloads_.select(cik_padded(field("payload", "$.cik", "string")).alias("cik")).join(company.select("cik"), "cik", "left_semi")
    return validate_family(values, asked).groupBy("status").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "status")


def cik_list(spark: SparkSession, path: str) -> DataFrame:
    """Company numbers of a text file: comments after #, the first comma field of a line."""
    line = F.trim(F.split_part(F.split_part("value", F.lit("#"), F.lit(1)), F.lit(","), F.lit(1)))
    return spark.read.text(path).select(line.alias("v")).where("v <> ''").select(cik_padded(F.col("v")).alias("cik")).distinct()


def enumerate_candidates(profiles: DataFrame, codes: tuple[str, ...], since: str, overrides: DataFrame) -> DataFrame:
    """Filers of the codes with a recent annual report or none at all, and every overridden one."""
    by_code = profiles.where(F.col("sic").isin(*codes) & ((F.col("latest_annual") >= since) | F.col("latest_annual").isNull()))
    return by_code.unionByName(profiles.join(overrides.select("cik"), "cik", "left_semi")).dropDuplicates(["cik"])
