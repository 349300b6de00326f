"""Column lists of the certificate files, in file order (CSV binds by position)."""

from __future__ import annotations

from pyspark.sql import types as T

# Names, order and types of the published files.
FILE_COLUMNS = {
    "raw_display_certificates": """
        lmk_key string, address1 string, address2 string, address3 string, postcode string,
        building_reference_number string, current_operational_rating double,
        yr1_operational_rating double, yr2_operational_rating double,
        operational_rating_band string, electric_co2 double, heating_co2 double,
        renewables_co2 double, property_type string, inspection_date date, local_authority string,
        constituency string, county string, lodgement_date date, main_benchmark string,
        main_heating_fuel string, other_fuel string, special_energy_uses string,
        renewable_sources string, total_floor_area bigint, annual_thermal_fuel_usage bigint,
        typical_thermal_fuel_usage bigint, annual_electrical_fuel_usage bigint,
        typical_electrical_fuel_usage bigint, renewables_fuel_thermal bigint,
        renewables_electrical double, yr1_electricity_co2 double, yr2_electricity_co2 double,
        yr1_heating_co2 double, yr2_heating_co2 double, yr1_renewables_co2 double,
        yr2_renewables_co2 double, aircon_present string, aircon_kw_rating double,
        estimated_aircon_kw_rating double, ac_inspection_commissioned double,
        building_environment string, building_category string, address string,
        local_authority_label string, constituency_label string, posttown string,
        nominated_date date, or_assessment_end_date date, lodgement_datetime timestamp,
        occupancy_level string, uprn bigint, uprn_source string, report_type bigint
    """,
    "raw_display_recommendations": """
        payback_type string, lmk_key string, recommendation_item bigint,
        recommendation_code string, recommendation string, co2_impact string
    """,
    "raw_non_domestic_certificates": """
        lmk_key string, address1 string, address2 string, address3 string, postcode string,
        building_reference_number string, asset_rating bigint, asset_rating_band string,
        property_type string, inspection_date timestamp, local_authority string,
        constituency string, county string, lodgement_date timestamp, transaction_type string,
        new_build_benchmark string, existing_stock_benchmark string, building_level string,
        main_heating_fuel string, other_fuel_desc string, special_energy_uses string,
        renewable_sources string, floor_area bigint, standard_emissions double,
        target_emissions double, typical_emissions double, building_emissions double,
        aircon_present string, aircon_kw_rating double, estimated_aircon_kw_rating double,
        ac_inspection_commissioned bigint, building_environment string, address string,
        local_authority_label string, constituency_label string, posttown string,
        lodgement_datetime timestamp, primary_energy_value bigint, uprn bigint, uprn_source string,
        report_type bigint
    """,
    "raw_non_domestic_recommendations": """
        payback_type string, lmk_key string, recommendation_item bigint,
        recommendation_code string, recommendation string, co2_impact string
    """,
    "raw_domestic_certificates": """
        lmk_key string, address1 string, address2 string, address3 string, postcode string,
        building_reference_number string, current_energy_rating string,
        potential_energy_rating string, current_energy_efficiency bigint,
        potential_energy_efficiency bigint, property_type string, built_form string,
        inspection_date date, local_authority string, constituency string, county string,
        lodgement_date date, transaction_type string, environmental_impact_current bigint,
        environmental_impact_potential bigint, energy_consumption_current double,
        energy_consumption_potential double, co2_emissions_current double,
        co2_emiss_curr_per_floor_area double, co2_emissions_potential double,
        lighting_cost_current double, lighting_cost_potential double, heating_cost_current double,
        heating_cost_potential double, hot_water_cost_current double,
        hot_water_cost_potential double, total_floor_area double, energy_tariff string,
        mains_gas_flag string, floor_level string, flat_top_storey string,
        flat_storey_count double, main_heating_controls string, multi_glaze_proportion double,
        glazed_type string, glazed_area string, extension_count bigint,
        number_habitable_rooms double, number_heated_rooms double, low_energy_lighting bigint,
        number_open_fireplaces bigint, hotwater_description string, hot_water_energy_eff string,
        hot_water_env_eff string, floor_description string, floor_energy_eff string,
        floor_env_eff string, windows_description string, windows_energy_eff string,
        windows_env_eff string, walls_description string, walls_energy_eff string,
        walls_env_eff string, secondheat_description string, sheating_energy_eff string,
        sheating_env_eff string, roof_description string, roof_energy_eff string,
        roof_env_eff string, mainheat_description string, mainheat_energy_eff string,
        mainheat_env_eff string, mainheatcont_description string, mainheatc_energy_eff string,
        mainheatc_env_eff string, lighting_description string, lighting_energy_eff string,
        lighting_env_eff string, main_fuel string, wind_turbine_count double,
        heat_loss_corridor string, unheated_corridor_length double, floor_height double,
        photo_supply double, solar_water_heating_flag string, mechanical_ventilation string,
        address string, local_authority_label string, constituency_label string, posttown string,
        construction_age_band string, lodgement_datetime timestamp, tenure string,
        fixed_lighting_outlets_count double, low_energy_fixed_light_count double, uprn bigint,
        uprn_source string, report_type bigint
    """,
    "raw_domestic_recommendations": """
        lmk_key string, improvement_item bigint, improvement_summary_text string,
        improvement_descr_text string, improvement_id bigint, improvement_id_text string,
        indicative_cost string
    """,
}


def file_schema(table: str) -> T.StructType:
    """Schema of the files behind a raw table."""
    return T.StructType.fromDDL(" ".join(FILE_COLUMNS[table].split()))


