"""The concept registry: what is looked for, under which tags, in which units."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

VOLUMES = ("MMBoe", "MBoe", "Boe", "boe", "MMBbls", "MBbls", "bbl", "MMcfe", "Bcf")


@dataclass(frozen=True)
class Concept:
    key: str
    label: str
    aliases: tuple[tuple[str, str], ...]
    units: tuple[str, ...] = ()

    def unit_rank(self, unit: str) -> int:
        """Position in the preferred units; after all of them for any other."""
        return self.units.index(unit) if unit in self.units else len(self.units)


# Public taxonomy tags in order of preference, and preferred units.
CONCEPTS = (
    Concept(
        "proved_developed_reserves_boe", "Developed reserves, proved",
        (("srt", "ProvedDevelopedReservesBOE1"), ("srt", "ProvedDevelopedReservesVolume"), ("us-gaap", "ProvedDevelopedReservesBOE1"), ("us-gaap", "ProvedDevelopedReservesVolume"), ("us-gaap", "ProvedDevelopedReservesBOE")),
        VOLUMES,
    ),
    Concept(
        "proved_undeveloped_reserves_boe", "Undeveloped reserves, proved",
        (("srt", "ProvedUndevelopedReserveBOE1"), ("srt", "ProvedUndevelopedReserveBOE"), ("srt", "ProvedUndevelopedReserveVolume"), ("srt", "ProvedUndevelopedReservesVolume"), ("us-gaap", "ProvedUndevelopedReserveBOE1"), ("us-gaap", "ProvedUndevelopedReserveBOE"), ("us-gaap", "ProvedUndevelopedReserveVolume")),
        VOLUMES,
    ),
    Concept(
        "proved_reserves_boe", "All proved reserves",
        (("srt", "ProvedDevelopedAndUndevelopedReservesNet"), ("srt", "ProvedDevelopedAndUndevelopedReserveNetEnergy"), ("us-gaap", "ProvedDevelopedAndUndevelopedReservesNet"), ("us-gaap", "ProvedDevelopedAndUndevelopedReserveNetEnergy")),
        VOLUMES,
    ),
    Concept(
        "standardized_measure", "Discounted future cash flows, standardised",
        (
            ("srt", "StandardizedMeasureOfDiscountedFutureNetCashFlowsRelatingToProvedOilAndGasReserves"), ("us-gaap", "StandardizedMeasureOfDiscountedFutureNetCashFlowsRelatingToProvedOilAndGasReserves"),
            ("srt", "StandardizedMeasureOfDiscountedFutureNetCashFlowRelatingToProvedOilAndGasReserves"), ("us-gaap", "StandardizedMeasureOfDiscountedFutureNetCashFlowRelatingToProvedOilAndGasReserves"),
        ),
        ("USD",),
    ),
    Concept(
        "production_volume", "Volume produced in the year",
        (("srt", "ProvedDevelopedAndUndevelopedReserveProductionEnergy"), ("srt", "ProvedDevelopedAndUndevelopedReserveProduction"), ("us-gaap", "ProvedDevelopedAndUndevelopedReserveProductionEnergy")),
        VOLUMES,
    ),
    Concept(
        "oil_and_gas_revenue", "Revenue from oil and gas",
        (("us-gaap", "OilAndGasRevenue"), ("us-gaap", "OilAndGasSalesRevenue"), ("us-gaap", "RevenueFromContractWithCustomerExcludingAssessedTax"), ("ifrs-full", "RevenueFromSaleOfOilAndGasProducts"), ("ifrs-full", "RevenueFromSaleOfCrudeOil"), ("ifrs-full", "RevenueFromSaleOfNaturalGas"), ("ifrs-full", "RevenueFromContractsWithCustomers"), ("ifrs-full", "Revenue")),
        ("USD",),
    ),
    Concept(
        "capex", "Capital spent",
        (("us-gaap", "PaymentsToAcquireOilAndGasProperty"), ("us-gaap", "PaymentsToExploreAndDevelopOilAndGasProperties"), ("us-gaap", "PaymentsToAcquirePropertyPlantAndEquipment"), ("ifrs-full", "PurchaseOfOilAndGasAssets"), ("ifrs-full", "PurchaseOfPropertyPlantAndEquipmentClassifiedAsInvestingActivities"), ("ifrs-full", "AdditionsOtherThanThroughBusinessCombinationsPropertyPlantAndEquipment")),
        ("USD",),
    ),
    Concept(
        "average_sales_price", "Price realised, average",
        (("srt", "AverageSalesPrices"), ("srt", "AverageSalePricePerUnitOfProduction"), ("us-gaap", "AverageSalesPrices")),
        ("USD/bbl", "USD/Bbl", "USD/Mcf", "USD/MMBTU", "USD/MMBtu"),
    ),
    Concept(
        "production_cost_per_boe", "Cost of production a unit",
        (("srt", "ConsolidatedOilAndGasProductionCostsPerUnitOfProduction"), ("srt", "ProductionCostsPerUnitOfProduction"), ("srt", "AverageProductionCostsPerBarrelOfOilEquivalentsBOE"), ("us-gaap", "ConsolidatedOilAndGasProductionCostsPerUnitOfProduction"), ("us-gaap", "AverageProductionCostsPerBarrelOfOilEquivalentsBOE")),
    ),
)
BY_KEY = {c.key: c for c in CONCEPTS}
DEVELOPED, UNDEVELOPED, TOTAL = (c.key for c in CONCEPTS[:3])
FAMILY = (DEVELOPED, UNDEVELOPED, TOTAL)

# The product that a rate unit names.
PRODUCT_OF_UNIT = {
    "USD/bbl": "oil", "USD/Bbl": "oil", "USD/bbls": "oil", "USD/Mcf": "gas", "USD/MMBTU": "gas", "USD/MMBtu": "gas",
    "USD/Mmbtu": "gas", "USD/MMcf": "gas", "USD/Mcfe": "gas", "USD/MMcfe": "gas",
}

# Cohorts by industry code, and codes known to hold no reserves.
SIC_COHORTS = {"1311": "Oil & Gas E&P", "6792": "Oil & Gas E&P", "2911": "Oil & Gas Integrated"}
NON_PRODUCING_SIC = {
    "1381": "Drilling Oil & Gas Wells", "1389": "Oil & Gas Field Services", "4922": "Natural Gas Transmission",
    "4923": "Natural Gas Transmission & Distribution", "4924": "Natural Gas Distribution",
    "5171": "Petroleum Bulk Stations & Terminals", "5172": "Petroleum & Petroleum Products Wholesalers",
}
NON_OPERATOR_SIC = ("6792",)
NON_OPERATOR_HINTS = ("royalt", "minerals", "trust")
WIDER_HINTS = (*NON_OPERATOR_HINTS, "midstream", "pipeline", "refin", "partners, l.p.")


def concept(key: str) -> Concept:
    """The registered concept; an unknown key is an error."""
    if key not in BY_KEY:
        raise KeyError(f"unknown concept {key!r}; known: {', '.join(BY_KEY)}")
    return BY_KEY[key]


def concepts_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c.key, c.label, i, len(c.units)) for i, c in enumerate(CONCEPTS)], "concept_key string, label string, concept_ord int, n_units int")


def aliases_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c.key, tx, tag, i) for c in CONCEPTS for i, (tx, tag) in enumerate(c.aliases)], "concept_key string, taxonomy string, tag string, alias_ord int")


def units_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c.key, u, i) for c in CONCEPTS for i, u in enumerate(c.units)], "concept_key string, unit string, unit_rank int")
