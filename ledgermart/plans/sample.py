"""Certificate-shaped raw tables derived from the order, line and event tables.

Every derivation is a row-wise SELECT over a whole table, written in SQL that Spark
and an independent SQL engine read alike, so that both start from equal input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermart.plans.schemas import FILE_COLUMNS
from ledgermart.sources.csv import BLOCK, SEQ

_ORDER_KEY = "concat('D', cast(o_orderkey - o_orderkey % 2 as string))"
_LINE_DOMESTIC_KEY = "concat('D', cast(l_orderkey - l_orderkey % 2 as string))"
_LINE_KEY = "concat('N', cast(l_orderkey - l_orderkey % 2 as string), '-', cast(l_linenumber as string))"
_EVENT_KEY = "concat('P', cast(event_id - event_id % 3 as string))"


@dataclass(frozen=True)
class Derived:
    """Source table, date column, step of the batch axis, and the derived columns."""

    source: str
    ts: str
    offset: int
    columns: dict[str, str]
    place: str | None = None
    daily: bool = False

    def audit(self) -> dict[str, str]:
        y, m, d = f"year({self.ts})", f"month({self.ts})", f"day({self.ts})"
        number = f"({y} - 1990) * 400 + {m} * 32" + (f" + {d}" if self.daily else "")
        day = d if self.daily else "1"
        return {
            "audit_id": f"cast({1000 + 100000 * self.offset} + {number} as string)",
            # hours of the day that exist in every zone
            "audit_ts": f"make_timestamp({y}, {m}, {day}, {6 + self.offset}, 0, 0)",
        }


def _band(number: str) -> str:
    return f"substring('ABCDEFG', cast(1 + {number} % 7 as int), 1)"


def _payback(number: str) -> str:
    return (
        f"case {number} % 6 when 0 then 'short' when 1 then 'medium' when 2 then 'long' "
        f"when 3 then 'other' when 4 then 'short' end"
    )


def _impact(number: str) -> str:
    return f"case {number} % 4 when 0 then 'HIGH' when 1 then 'MEDIUM' when 2 then 'LOW' else 'Unknown' end"


DERIVED = {
    "raw_domestic_certificates": Derived(
        "orders", "o_orderdate", 1,
        {
            "lmk_key": _ORDER_KEY,
            "address1": "concat(' ', cast(o_custkey % 90 as string), ' High Street')",
            "address2": "case o_custkey % 5 when 0 then 'NA' when 1 then null else concat('Flat ', cast(o_custkey % 7 as string)) end",
            "postcode": "concat('AB', cast(o_custkey % 20 as string), ' 1XY')",
            "building_reference_number": "cast(o_custkey as string)",
            "current_energy_rating": f"case when o_orderkey % 50 = 0 then 'a' else {_band('o_orderkey')} end",
            "potential_energy_rating": _band("o_custkey"),
            "current_energy_efficiency": "o_orderkey % 101",
            "potential_energy_efficiency": "50 + o_orderkey % 53",
            "property_type": "o_orderstatus",
            "built_form": "o_orderpriority",
            "lodgement_date": "cast(o_orderdate as date)",
            "lodgement_datetime": "o_orderdate",
            "local_authority": "concat('LA ', cast(o_custkey % 30 as string))",
            "constituency": "concat('Area ', cast(o_custkey % 40 as string))",
            "posttown": "concat(' Town ', cast(o_custkey % 9 as string))",
            "transaction_type": "o_orderpriority",
            "environmental_impact_current": "o_orderkey % 97",
            "energy_consumption_current": "cast(o_orderkey % 400 as double)",
            "co2_emissions_current": "cast(o_orderkey % 37 as double) / 4",
            "total_floor_area": "cast(o_custkey % 200 as double)",
            "lighting_cost_current": "case when o_orderkey % 11 = 0 then null else cast(o_orderkey % 80 as double) end",
            "heating_cost_current": "cast(o_custkey % 900 as double)",
            "hot_water_cost_current": "cast(o_custkey % 150 as double) / 2",
            "mains_gas_flag": "case o_orderkey % 4 when 0 then 'Y' when 1 then 'y' when 2 then 'N' end",
            "tenure": "case o_custkey % 2 when 0 then 'owned' else 'rented' end",
            "uprn": "case when o_custkey % 3 = 0 then null else o_custkey end",
            "report_type": "100",
        },
        place="o_orderkey",
    ),
    "raw_non_domestic_certificates": Derived(
        "lineitem", "l_shipdate", 2,
        {
            "lmk_key": _LINE_KEY,
            "address1": "concat(cast(l_suppkey % 50 as string), ' Mill Lane')",
            "postcode": "concat('ZE', cast(l_suppkey % 10 as string), ' 9ZZ')",
            "building_reference_number": "cast(l_partkey as string)",
            "asset_rating": "l_partkey % 150",
            "asset_rating_band": f"case when l_partkey % 8 = 0 then 'A+' when l_partkey % 31 = 0 then 'a' else {_band('l_suppkey')} end",
            "property_type": "l_linestatus",
            "lodgement_date": "l_shipdate",
            "lodgement_datetime": "l_shipdate",
            "local_authority": "concat('LA ', cast(l_suppkey % 30 as string))",
            "county": "l_returnflag",
            "floor_area": "l_partkey % 300",
            "standard_emissions": "cast(l_suppkey % 64 as double) / 8",
            "target_emissions": "cast(l_partkey % 32 as double) / 4",
            "building_emissions": "case when l_partkey % 13 = 0 then null else cast(l_partkey % 90 as double) / 2 end",
            "aircon_present": "case l_linenumber % 3 when 0 then 'Yes' when 1 then 'yes' else 'No' end",
            "building_environment": "concat('Env ', cast(l_suppkey % 5 as string))",
            "primary_energy_value": "l_partkey % 500",
            "uprn": "case when l_suppkey % 4 = 0 then null else l_suppkey end",
            "report_type": "102",
        },
        place="l_partkey * 1000000 + l_suppkey",
    ),
    "raw_display_certificates": Derived(
        "events", "ts", 3,
        {
            "lmk_key": _EVENT_KEY,
            "address1": "concat(cast(user_id % 70 as string), ' Civic Square')",
            "postcode": "'EH1 1AA'",
            "building_reference_number": "cast(user_id as string)",
            "current_operational_rating": "cast(event_id % 150 as double)",
            "operational_rating_band": _band("event_id"),
            "electric_co2": "case when event_id % 10 = 0 then null else cast(event_id % 16 as double) / 4 end",
            "heating_co2": "cast(user_id % 32 as double) / 4",
            "property_type": "event_type",
            "lodgement_datetime": "ts",
            "total_floor_area": "user_id % 500",
            "uprn": "user_id",
            "report_type": "101",
        },
        place="event_id",
        daily=True,
    ),
    "raw_domestic_recommendations": Derived(
        "lineitem", "l_shipdate", 4,
        {
            "lmk_key": _LINE_DOMESTIC_KEY,
            "improvement_item": "l_linenumber",
            "improvement_summary_text": "l_returnflag",
            "improvement_id": "l_partkey % 60",
            "indicative_cost": "case l_suppkey % 4 when 0 then 'Low cost' when 1 then 'MEDIUM' when 2 then 'higher' end",
        },
    ),
    "raw_non_domestic_recommendations": Derived(
        "lineitem", "l_shipdate", 5,
        {
            "payback_type": _payback("l_partkey"),
            "lmk_key": _LINE_KEY,
            "recommendation_item": "l_linenumber",
            "recommendation_code": "concat('R', cast(l_partkey % 40 as string))",
            "co2_impact": _impact("l_suppkey"),
        },
    ),
    "raw_display_recommendations": Derived(
        "events", "ts", 6,
        {
            "payback_type": _payback("event_id"),
            "lmk_key": _EVENT_KEY,
            "recommendation_item": "event_id % 9",
            "recommendation_code": "concat('R', cast(event_id % 25 as string))",
            "co2_impact": _impact("user_id"),
        },
        daily=True,
    ),
}


def _file_columns(table: str) -> list[tuple[str, str]]:
    return [tuple(c.split()) for c in " ".join(FILE_COLUMNS[table].split()).split(", ")]


def _casts(table: str) -> list[tuple[str, str]]:
    """Every file column and its SQL: the derived one, or a typed NULL."""
    columns = DERIVED[table].columns
    return [(f"cast({columns.get(name, 'null')} as {kind})", name) for name, kind in _file_columns(table)]


def raw(spark: SparkSession, sf_dir: str, table: str, position: bool = False) -> DataFrame:
    """A raw table as the loader would have written it."""
    d = DERIVED[table]
    source = spark.read.parquet(f"{sf_dir}/{d.source}.parquet")
    place = [f"0L as {BLOCK}", f"{d.place} as {SEQ}"] if position and d.place else []
    return source.selectExpr(*[f"{e} as {n}" for e, n in _casts(table)], f"{d.audit()['audit_id']} as audit_id", *place)


def raw_sql(table: str, position: bool = False) -> str:
    d = DERIVED[table]
    columns = ", ".join(f"{e} as {n}" for e, n in _casts(table))
    columns += f", {d.place} as place" if position and d.place else ""
    return f"select {columns}, {d.audit()['audit_id']} as audit_id from {d.source}"


def ledger(spark: SparkSession, sf_dir: str, *tables: str) -> DataFrame:
    """Ledger rows of the given raw tables: one file per batch."""
    frames = []
    for t in tables or DERIVED:
        a = DERIVED[t].audit()
        source = spark.read.parquet(f"{sf_dir}/{DERIVED[t].source}.parquet")
        files = source.selectExpr(f"{a['audit_id']} as audit_id", f"{a['audit_ts']} as audit_ts").distinct()
        frames.append(
            files.select(
                "audit_id",
                F.concat(F.lit(f"raw/{t}/"), "audit_id", F.lit(".csv")).alias("filepath"),
                F.lit(t).alias("target_table"),
                F.lit("LOADED").alias("status"),
                "audit_ts",
                F.lit("run").alias("dag_run_id"),
            )
        )
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def ledger_sql(*tables: str) -> str:
    return " union all ".join(
        f"select distinct {DERIVED[t].audit()['audit_id']} as audit_id, "
        f"concat('raw/{t}/', {DERIVED[t].audit()['audit_id']}, '.csv') as filepath, '{t}' as target_table, "
        f"'LOADED' as status, {DERIVED[t].audit()['audit_ts']} as audit_ts, 'run' as dag_run_id "
        f"from {DERIVED[t].source}"
        for t in (tables or DERIVED)
    )


