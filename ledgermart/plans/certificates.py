"""The certificate mart: its datasets as specifications over the generic operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermart.functions.text import identity_key
from ledgermart.operators import kpi, quality
from ledgermart.operators.incremental import newer_than
from ledgermart.operators.keys import entity_delta, latest_per_key, latest_whole_rows, union_conformed
from ledgermart.operators.ledger import LEDGER
from ledgermart.sources.csv import BLOCK, SEQ

BATCH = "audit_ts"
KEY = "lmk_key"
DOMAINS = ("domestic", "non_domestic", "display")
SHORT = {"domestic": "dom", "non_domestic": "non_dom", "display": "disp"}
PROPERTY_KEY, PROPERTY_STATE = "property_identity_key", "property_bk"

# The columns that identify a property and those that describe its state.
IDENTITY_COLUMNS = ("address1", "address2", "address3", "postcode")
IDENTITY_RAW_COLUMNS = ("building_reference_number",)
STATE_COLUMNS = (
    "local_authority", "local_authority_label", "constituency", "constituency_label", "county",
    "posttown", "property_type", "built_form", "construction_age_band", "tenure",
)
PROPERTY_COLUMNS = {
    **{c: "string" for c in IDENTITY_COLUMNS},
    **{c: "string" for c in STATE_COLUMNS},
    "building_reference_number": "string", "uprn": "bigint", "report_type": "bigint", "audit_ts": "timestamp",
}

# The measures each energy fact keeps besides its keys.
FACT_COLUMNS = {
    "display": (
        "current_operational_rating", "yr1_operational_rating", "yr2_operational_rating", "aircon_kw_rating",
        "estimated_aircon_kw_rating", "electric_co2", "yr1_electricity_co2", "yr2_electricity_co2",
        "heating_co2", "yr1_heating_co2", "yr2_heating_co2", "renewables_co2", "yr1_renewables_co2",
        "yr2_renewables_co2", "renewables_electrical", "renewables_fuel_thermal", "annual_thermal_fuel_usage",
        "annual_electrical_fuel_usage", "typical_thermal_fuel_usage", "typical_electrical_fuel_usage",
        "special_energy_uses", "operational_rating_band", "main_benchmark", "total_floor_area",
        "lodgement_date", "nominated_date", "or_assessment_end_date", "inspection_date",
    ),
    "domestic": (
        "current_energy_rating", "potential_energy_rating", "current_energy_efficiency",
        "potential_energy_efficiency", "environmental_impact_current", "environmental_impact_potential",
        "energy_consumption_current", "energy_consumption_potential", "co2_emissions_current",
        "co2_emiss_curr_per_floor_area", "co2_emissions_potential", "total_floor_area", "lighting_cost_current",
        "lighting_cost_potential", "heating_cost_current", "heating_cost_potential", "hot_water_cost_current",
        "hot_water_cost_potential", "energy_tariff", "mains_gas_flag", "floor_level", "flat_top_storey",
        "flat_storey_count", "main_heating_controls", "multi_glaze_proportion", "glazed_type", "glazed_area",
        "extension_count", "number_habitable_rooms", "number_heated_rooms", "low_energy_lighting",
        "number_open_fireplaces", "main_fuel", "wind_turbine_count", "solar_water_heating_flag", "photo_supply",
        "mechanical_ventilation", "transaction_type", "tenure", "report_type", "inspection_date",
        "lodgement_date",
    ),
    "non_domestic": (
        "asset_rating", "asset_rating_band", "property_type", "main_heating_fuel", "other_fuel_desc",
        "floor_area", "standard_emissions", "target_emissions", "typical_emissions", "building_emissions",
        "aircon_present", "aircon_kw_rating", "estimated_aircon_kw_rating", "building_environment",
        "existing_stock_benchmark", "new_build_benchmark", "transaction_type", "inspection_date",
        "lodgement_date", "primary_energy_value", "report_type",
    ),
}

# Accepted bands and categories.
BANDS = ("A", "B", "C", "D", "E", "F", "G")
ASSET_BANDS = ("A+", *BANDS)
PAYBACK_TYPES = ("short", "medium", "long", "other")
CO2_IMPACTS = ("HIGH", "MEDIUM", "LOW")

_HIGH = "in ('A', 'B', 'C')"
_COST = "lighting_cost_current + heating_cost_current + hot_water_cost_current"


def _recommendation_metrics(item: str) -> list[kpi.Metric]:
    return [
        kpi.distinct_per_key(
            "monthly_avg_recommendations_per_property", "global_avg_recommendations_per_property", item, KEY
        ),
        kpi.distinct_count("total_properties", "global_total_properties", KEY),
        kpi.row_count("total_recommendations", "global_total_recommendations"),
    ]


def _cost_range(level: str) -> kpi.Metric:
    return kpi.percent(
        f"pct_{level}_cost_range", f"global_pct_{level}_cost_range", f"contains(lower(indicative_cost), '{level}')"
    )


# The names and formulas of the KPIs.
METRICS: dict[str, list[kpi.Metric]] = {
    "kpi_disp_rating": [
        kpi.mean(
            "monthly_avg_operational_rating", "global_avg_operational_rating", "current_operational_rating", digits=None
        ),
        kpi.percent("pct_high_band", "global_pct_high_band", f"operational_rating_band {_HIGH}"),
        kpi.ratio_of_sums(
            "monthly_avg_co2_per_m2", "global_avg_co2_per_m2", "electric_co2 + heating_co2", "total_floor_area"
        ),
    ],
    "kpi_dom_rating": [
        kpi.mean("monthly_avg_efficiency", "global_avg_efficiency", "current_energy_efficiency"),
        kpi.mean("monthly_potential_efficiency", "global_potential_efficiency", "potential_energy_efficiency"),
        kpi.mean("monthly_avg_co2_tonnes", "global_avg_co2_tonnes", "co2_emissions_current"),
        kpi.ratio_of_sums(
            "monthly_avg_co2_per_m2", "global_avg_co2_per_m2", "co2_emissions_current", "total_floor_area"
        ),
        kpi.ratio_of_sums(
            "monthly_avg_consumption_per_m2", "global_avg_consumption_per_m2",
            "energy_consumption_current", "total_floor_area",
        ),
        kpi.mean("monthly_avg_energy_cost", "global_avg_energy_cost", _COST),
        kpi.percent("pct_with_mains_gas", "global_pct_with_mains_gas", "lower(mains_gas_flag) = 'y'"),
        kpi.percent("pct_high_rating", "global_pct_high_rating", f"current_energy_rating {_HIGH}"),
    ],
    "kpi_non_dom_rating": [
        kpi.mean("monthly_avg_asset_rating", "global_avg_asset_rating", "asset_rating"),
        kpi.percent("pct_high_band", "global_pct_high_band", "asset_rating_band in ('A+', 'A', 'B', 'C')"),
        kpi.mean("monthly_avg_emissions_per_m2", "global_avg_emissions_per_m2", "building_emissions"),
        kpi.weighted_mean(
            "monthly_weighted_emissions_per_m2", "global_weighted_emissions_per_m2", "building_emissions", "floor_area"
        ),
        kpi.mean("avg_gap_vs_target", "global_avg_gap_vs_target", "building_emissions - target_emissions"),
        kpi.mean("avg_gap_vs_standard", "global_avg_gap_vs_standard", "building_emissions - standard_emissions"),
        kpi.mean("monthly_avg_primary_energy_value", "global_avg_primary_energy_value", "primary_energy_value"),
        kpi.percent("pct_with_aircon", "global_pct_with_aircon", "lower(aircon_present) = 'yes'"),
        kpi.distinct_count(
            "distinct_building_environments", "global_distinct_building_environments", "building_environment"
        ),
    ],
    "kpi_dom_recom": [
        *_recommendation_metrics("improvement_item"),
        *[_cost_range(level) for level in ("low", "medium", "high")],
    ],
    "kpi_disp_recom": _recommendation_metrics("recommendation_item"),
    "kpi_non_dom_recom": _recommendation_metrics("recommendation_item"),
}
SPLIT_BY = {"kpi_disp_recom": "payback_type", "kpi_non_dom_recom": "payback_type"}
FACT_OF_KPI = {
    "kpi_dom_rating": "fact_dom_energy",
    "kpi_non_dom_rating": "fact_non_dom_energy",
    "kpi_disp_rating": "fact_disp_energy",
    "kpi_dom_recom": "fact_dom_recom",
    "kpi_non_dom_recom": "fact_non_dom_recom",
    "kpi_disp_recom": "fact_disp_recom",
}


def raw_name(domain: str, kind: str) -> str:
    return f"raw_{domain}_{kind}"


def staging_name(domain: str, kind: str) -> str:
    return f"stg_{domain}_{kind}"


def fact_name(domain: str, kind: str) -> str:
    return f"fact_{SHORT[domain]}_{'energy' if kind == 'certificates' else 'recom'}"


def latest_certificates(staged: DataFrame, after: str | None = None, narrow: bool = False) -> DataFrame:
    """Staged certificates as an upsert by key would leave them, newer than ``after``.

    The newest row of a key is newer than the watermark exactly if any of its rows
    is, so the filter may run first and old batches are never read. Inside a batch
    the later lodgement wins, then the row that stands later in the file: narrow
    columns, so a reader of two columns does not make Spark sort and move ninety.
    Readers of a few columns say ``narrow``: those are sorted and moved with the
    places. For all others the rows follow once their places are known.
    """
    fresh = staged.filter(newer_than(BATCH, after))
    ties = ("lodgement_datetime", BLOCK, SEQ)
    if narrow:
        return latest_per_key(fresh, KEY, BATCH, [F.desc_nulls_last(c) for c in ties]).drop(BLOCK, SEQ)
    return latest_whole_rows(fresh, KEY, [BATCH, *ties]).drop(BLOCK, SEQ)


def property_delta(staged: Sequence[DataFrame], after: str | None = None) -> DataFrame:
    """Latest state of every property seen since the watermark, over all domains."""
    return entity_delta(
        staged,
        PROPERTY_COLUMNS,
        id_col="uprn",
        identity_cols=IDENTITY_COLUMNS,
        identity_raw_cols=IDENTITY_RAW_COLUMNS,
        state_cols=STATE_COLUMNS,
        ts_col=BATCH,
        key_name=PROPERTY_KEY,
        state_name=PROPERTY_STATE,
        watermark=after,
    )


def property_delta_input(staged: Sequence[DataFrame]) -> DataFrame:
    """Staged certificates of all domains in the property shape."""
    return union_conformed(staged, PROPERTY_COLUMNS)


def fact_energy(staged: DataFrame, domain: str) -> DataFrame:
    """Narrow energy fact: keys, batch and measures."""
    key = identity_key("uprn", IDENTITY_COLUMNS, IDENTITY_RAW_COLUMNS).alias(PROPERTY_KEY)
    return staged.select(key, KEY, BATCH, *FACT_COLUMNS[domain])


def fact_recommendations(staged: DataFrame) -> DataFrame:
    return staged.select("*")


def kpi_table(name: str, fact: DataFrame, since: str | None = None) -> DataFrame:
    """A KPI straight from its fact."""
    return kpi.kpi_report(fact, BATCH, METRICS[name], SPLIT_BY.get(name), since)


# -- checks ---------------------------------------------------------------------


def _keyed(table: str, audited: bool = True) -> list[quality.Check]:
    checks = [*quality.not_null(table, KEY, "audit_id")]
    return checks + ([quality.relationship(table, "audit_id", LEDGER)] if audited else [])


def _layer(name) -> list[quality.Check]:
    checks: list[quality.Check] = []
    for domain in ("display", "domestic", "non_domestic"):
        parent, child = name(domain, "certificates"), name(domain, "recommendations")
        checks += [*_keyed(parent), quality.unique(parent, KEY)]
        checks += [*_keyed(child), quality.relationship(child, KEY, parent)]
    return checks


# What each layer is checked for.
RAW_CHECKS: list[quality.Check] = [
    *quality.not_null(LEDGER, "audit_id", "filepath", "status", "audit_ts"),
    quality.unique(LEDGER, "audit_id"),
    quality.unique(LEDGER, "filepath"),
    quality.accepted_values(LEDGER, "status", ["LOADED"]),
    *_layer(raw_name),
]

STAGING_CHECKS: list[quality.Check] = [
    *_layer(staging_name),
    quality.in_set("stg_display_certificates", "operational_rating_band", BANDS),
    *quality.not_null("stg_display_recommendations", "payback_type"),
    quality.in_set("stg_display_recommendations", "payback_type", PAYBACK_TYPES),
    quality.in_set("stg_display_recommendations", "co2_impact", CO2_IMPACTS),
    quality.in_set("stg_domestic_certificates", "current_energy_rating", BANDS),
    quality.in_set("stg_domestic_certificates", "potential_energy_rating", BANDS),
    quality.between("stg_domestic_certificates", "total_floor_area", 1, 20000),
    quality.between("stg_non_domestic_certificates", "floor_area", 1, 200000),
    quality.in_set("stg_non_domestic_certificates", "asset_rating_band", ASSET_BANDS),
    *quality.not_null("stg_non_domestic_recommendations", "payback_type"),
]

PRESENTATION_CHECKS: list[quality.Check] = [
    *[c for d in DOMAINS for c in quality.not_null(fact_name(d, "certificates"), PROPERTY_KEY, KEY, BATCH)],
    *[quality.unique(fact_name(d, "certificates"), f"{KEY}, {BATCH}") for d in DOMAINS],
    *[c for d in DOMAINS for c in quality.not_null(fact_name(d, "recommendations"), KEY, BATCH)],
    *[quality.unique(n, ", ".join([BATCH, *([SPLIT_BY[n]] if n in SPLIT_BY else [])])) for n in METRICS],
]


def raw_checks(reissues: bool = False) -> list[quality.Check]:
    """Checks of the raw layer. With ``reissues`` a certificate may come again in a later file."""
    if not reissues:
        return RAW_CHECKS
    return [
        quality.unique(c.table, f"{KEY}, audit_id") if c.test == quality.UNIQUE and c.column == KEY else c
        for c in RAW_CHECKS
    ]
