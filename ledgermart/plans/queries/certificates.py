"""The certificate mart's own datasets, on certificate-shaped tables derived from the test tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermart.operators import ledger as lg
from ledgermart.operators import quality
from ledgermart.operators.check_log import CheckLog
from ledgermart.plans import certificates as spec
from ledgermart.plans import sample
from ledgermart.plans.queries.registry import naive, new_mart, query
from ledgermart.plans.schemas import FILE_COLUMNS

# -- Spark side ---------------------------------------------------------------------


def staged(spark, sf_dir, domain: str, kind: str, after: str | None = None, narrow: bool = False) -> DataFrame:
    table, keyed = spec.raw_name(domain, kind), kind == "certificates"
    raw = sample.raw(spark, sf_dir, table, position=keyed)
    rows = lg.join_audit(raw, sample.ledger(spark, sf_dir, table), table, after)
    return spec.latest_certificates(rows, narrow=narrow) if keyed else rows


def fact(spark, sf_dir, domain: str, kind: str, narrow: bool = False) -> DataFrame:
    rows = staged(spark, sf_dir, domain, kind, narrow=narrow)
    return spec.fact_energy(rows, domain) if kind == "certificates" else spec.fact_recommendations(rows)


# -- SQL side -----------------------------------------------------------------------


def _columns(table: str) -> list[str]:
    return [c.split()[0] for c in " ".join(FILE_COLUMNS[table].split()).split(", ")]


def _staged_sql(domain: str, kind: str) -> str:
    table = spec.raw_name(domain, kind)
    joined = (
        f"select r.*, a.audit_ts from ({sample.raw_sql(table, kind == 'certificates')}) r "
        f"join ({sample.ledger_sql(table)}) a on r.audit_id = a.audit_id"
    )
    if kind == "recommendations":
        return joined
    return (
        "select * exclude (rn, place) from (select *, row_number() over (partition by lmk_key order by audit_ts desc, "
        f"lodgement_datetime desc nulls last, place desc) as rn from ({joined})) where rn = 1"
    )


def _norm(c: str) -> str:
    return f"replace(lower(coalesce(trim({c}), 'NA')), ' ', '')"


_KEY_SQL = (
    "coalesce(nullif(cast(uprn as varchar), ''), md5(concat_ws('|', "
    + ", ".join(_norm(c) for c in ("address1", "address2", "address3", "postcode"))
    + ", coalesce(building_reference_number, 'NA'))))"
)
_STATE = (
    "local_authority local_authority_label constituency constituency_label county posttown "
    "property_type built_form construction_age_band tenure"
).split()
_STATE_SQL = "md5(concat_ws('|', " + ", ".join(_norm(c) for c in _STATE) + "))"
_PROPERTY = ["address1", "address2", "address3", "postcode", *_STATE, "building_reference_number", "uprn", "report_type"]


def _fact_sql(domain: str, kind: str) -> str:
    if kind == "recommendations":
        return _staged_sql(domain, kind)
    columns = ", ".join(spec.FACT_COLUMNS[domain])
    return f"select {_KEY_SQL} as property_identity_key, lmk_key, audit_ts, {columns} from ({_staged_sql(domain, kind)})"


def _property_rows_sql() -> str:
    """Staged certificates of all domains in the property shape."""

    def one(domain: str) -> str:
        have = set(_columns(spec.raw_name(domain, "certificates")))
        shaped = ", ".join(c if c in have else f"cast(null as varchar) as {c}" for c in _PROPERTY)
        return f"select {shaped}, audit_ts from ({_staged_sql(domain, 'certificates')})"

    keyed = f"{_KEY_SQL} as property_identity_key, {_STATE_SQL} as property_bk"
    return f"select *, {keyed} from (" + " union all ".join(one(d) for d in spec.DOMAINS) + ")"


def _latest_property_sql(rows: str, *partition: str) -> str:
    others = ", ".join(f"{c} asc nulls last" for c in _PROPERTY)
    by = ", ".join(["property_identity_key", *partition])
    return (
        f"select * exclude (rn) from (select *, row_number() over (partition by {by} "
        f"order by audit_ts desc, property_bk asc nulls last, {others}) as rn from ({rows})) where rn = 1"
    )


def _pct(condition: str) -> str:
    return f"round(100.0 * sum(case when {condition} then 1 else 0 end) / count(*), 2)"


def _per(a: str, b: str) -> str:
    return f"round(sum({a}) / nullif(sum({b}), 0), 2)"


def _recom(item: str, p: str) -> str:
    prefix = "global_" if p == "g" else ""
    avg = "global_avg" if p == "g" else "monthly_avg"
    return (
        f"round(cast(count(distinct {item}) as double) / count(distinct lmk_key), 2) as {avg}_recommendations_per_property, "
        f"count(distinct lmk_key) as {prefix}total_properties, count(*) as {prefix}total_recommendations"
    )


def _kpi_columns(name: str, p: str) -> str:
    """Columns of one KPI: ``m`` per batch, ``g`` over everything."""
    g = p == "g"
    avg, pct = ("global_avg" if g else "monthly_avg"), ("global_pct" if g else "pct")
    if name == "kpi_disp_rating":
        rating = "avg(current_operational_rating)"
        return ", ".join([
            f"{f'round({rating}, 2)' if g else rating} as {avg}_operational_rating",
            f"{_pct('''operational_rating_band in ('A', 'B', 'C')''')} as {pct}_high_band",
            f"{_per('electric_co2 + heating_co2', 'total_floor_area')} as {avg}_co2_per_m2",
        ])
    if name == "kpi_dom_rating":
        cost = "lighting_cost_current + heating_cost_current + hot_water_cost_current"
        return ", ".join([
            f"round(avg(current_energy_efficiency), 2) as {avg}_efficiency",
            f"round(avg(potential_energy_efficiency), 2) as {'global' if g else 'monthly'}_potential_efficiency",
            f"round(avg(co2_emissions_current), 2) as {avg}_co2_tonnes",
            f"{_per('co2_emissions_current', 'total_floor_area')} as {avg}_co2_per_m2",
            f"{_per('energy_consumption_current', 'total_floor_area')} as {avg}_consumption_per_m2",
            f"round(avg({cost}), 2) as {avg}_energy_cost",
            f"{_pct('''lower(mains_gas_flag) = 'y' ''')} as {pct}_with_mains_gas",
            f"{_pct('''current_energy_rating in ('A', 'B', 'C')''')} as {pct}_high_rating",
        ])
    if name == "kpi_non_dom_rating":
        gap = "global_avg_gap" if g else "avg_gap"
        return ", ".join([
            f"round(avg(asset_rating), 2) as {avg}_asset_rating",
            f"{_pct('''asset_rating_band in ('A+', 'A', 'B', 'C')''')} as {pct}_high_band",
            f"round(avg(building_emissions), 2) as {avg}_emissions_per_m2",
            f"{_per('building_emissions * floor_area', 'floor_area')} as {'global' if g else 'monthly'}_weighted_emissions_per_m2",
            f"round(avg(building_emissions - target_emissions), 2) as {gap}_vs_target",
            f"round(avg(building_emissions - standard_emissions), 2) as {gap}_vs_standard",
            f"round(avg(primary_energy_value), 2) as {avg}_primary_energy_value",
            f"{_pct('''lower(aircon_present) = 'yes' ''')} as {pct}_with_aircon",
            f"count(distinct building_environment) as {'global_' if g else ''}distinct_building_environments",
        ])
    if name == "kpi_dom_recom":
        ranges = [
            f"{_pct(f'''lower(indicative_cost) like '%{level}%' ''')} as {pct}_{level}_cost_range"
            for level in ("low", "medium", "high")
        ]
        return ", ".join([_recom("improvement_item", p), *ranges])
    return _recom("recommendation_item", p)


def _kpi_sql(name: str) -> str:
    domain = {v: k for k, v in spec.SHORT.items()}[spec.FACT_OF_KPI[name].removeprefix("fact_").rsplit("_", 1)[0]]
    kind = "certificates" if spec.FACT_OF_KPI[name].endswith("energy") else "recommendations"
    monthly = _kpi_columns(name, "m")
    if name in spec.SPLIT_BY:
        rows = (
            f"select audit_ts, 'ALL' as payback_type, {monthly} from f group by audit_ts "
            f"union all select audit_ts, payback_type, {monthly} from f group by audit_ts, payback_type"
        )
    else:
        rows = f"select audit_ts, {monthly} from f group by audit_ts"
    return (
        f"with f as ({_fact_sql(domain, kind)}), m as ({rows}), g as (select {_kpi_columns(name, 'g')} from f) "
        "select m.*, g.* from m cross join g"
    )


# -- registration -------------------------------------------------------------------


def _staged_query(domain, kind, spark, sf_dir):
    return naive(staged(spark, sf_dir, domain, kind))


def _fact_query(domain, kind, spark, sf_dir):
    return naive(fact(spark, sf_dir, domain, kind))


def _kpi_query(name, spark, sf_dir):
    domain = {v: k for k, v in spec.SHORT.items()}[spec.FACT_OF_KPI[name].removeprefix("fact_").rsplit("_", 1)[0]]
    kind = "certificates" if spec.FACT_OF_KPI[name].endswith("energy") else "recommendations"
    return naive(spec.kpi_table(name, fact(spark, sf_dir, domain, kind, narrow=True)))


for _domain in spec.DOMAINS:
    for _kind in ("certificates", "recommendations"):
        query(spec.staging_name(_domain, _kind), _staged_sql(_domain, _kind))(partial(_staged_query, _domain, _kind))
        query(spec.fact_name(_domain, _kind), _fact_sql(_domain, _kind))(partial(_fact_query, _domain, _kind))
for _name in spec.METRICS:
    query(_name, _kpi_sql(_name))(partial(_kpi_query, _name))


@query("raw_copy_audit", sample.ledger_sql())
def raw_copy_audit(spark, sf_dir):
    return naive(sample.ledger(spark, sf_dir))


def _raw_query(table, spark, sf_dir):
    return naive(sample.raw(spark, sf_dir, table))


for _table in sample.DERIVED:
    query(_table, sample.raw_sql(_table))(partial(_raw_query, _table))


def _certificates(spark, sf_dir, after=None) -> list[DataFrame]:
    return [staged(spark, sf_dir, d, "certificates", after, narrow=True) for d in spec.DOMAINS]


@query("delta_property", _latest_property_sql(f"select * from ({_property_rows_sql()}) where audit_ts > timestamp '1996-06-15'"))
def delta_property(spark, sf_dir):
    after = "1996-06-15"
    return naive(spec.property_delta(_certificates(spark, sf_dir, after), after))


# three runs of the history: what they read of the batch axis, the last one to its end, and their timestamps
_RUNS = ((None, "1997-12-31", "1997-12-31"), ("1997-12-31", "1999-12-31", "1999-12-31"), ("1999-12-31", None, "2030-01-01"))
_RUN_SQL = (
    "case when audit_ts <= timestamp '1997-12-31' then timestamp '1997-12-31' "
    "when audit_ts <= timestamp '1999-12-31' then timestamp '1999-12-31' else timestamp '2030-01-01' end"
)


def _dim_sql() -> str:
    states = _latest_property_sql(f"select *, {_RUN_SQL} as run_ts from ({_property_rows_sql()})", "run_ts")
    return f"""
    with s as ({states}),
    l as (select *, lag(property_bk) over (partition by property_identity_key order by run_ts) as previous from s),
    c as (select * exclude (previous) from l where previous is distinct from property_bk)
    select * exclude (run_ts), run_ts as valid_from,
           lead(run_ts) over (partition by property_identity_key order by run_ts) as valid_to,
           md5(concat_ws('|', property_identity_key, strftime(run_ts, '%Y%m%d%H%M%S%f'))) as scd_id
    from c
    """


def _property_dimension(spark, sf_dir):
    mart = new_mart(spark, "property")
    # the staged certificates are written once; every run reads only its own batches
    mart.write_full("staged", spec.property_delta_input(_certificates(spark, sf_dir)))
    for after, until, run in _RUNS:
        rows = mart.table("staged")
        rows = rows if until is None else rows.filter(F.col(spec.BATCH) <= F.lit(until))
        delta = spec.property_delta([rows], after)
        mart.write_snapshot("dim", delta, spec.PROPERTY_KEY, [spec.PROPERTY_STATE], f"{run} 00:00:00")
    return mart


@query("dim_property", _dim_sql())
def dim_property(spark, sf_dir):
    return naive(_property_dimension(spark, sf_dir).table("dim"))


@query("dim_property_current", f"select *, true as is_current from ({_dim_sql()}) where valid_to is null")
def dim_property_current(spark, sf_dir):
    return naive(_property_dimension(spark, sf_dir).current("dim"))


# -- checks -------------------------------------------------------------------------


def _check_sql(c: quality.Check, tables: dict[str, str]) -> str:
    t = tables[c.table]
    keys = [k.strip() for k in c.column.split(",")]
    if c.test == quality.NOT_NULL:
        count = f"select count(*) from {t} where {c.column} is null"
    elif c.test == quality.UNIQUE:
        by = ", ".join(keys)
        known = " and ".join(f"{k} is not null" for k in keys)
        count = f"select count(*) from (select {by} from {t} where {known} group by {by} having count(*) > 1)"
    elif c.test == quality.RELATIONSHIPS:
        count = (
            f"select count(*) from {t} where {c.column} is not null and {c.column} not in "
            f"(select {c.parent_column} from {tables[c.parent]} where {c.parent_column} is not null)"
        )
    elif c.test == quality.BETWEEN:
        count = f"select count(*) from {t} where not {c.column} between {c.low} and {c.high}"
    else:
        listed = ", ".join(f"'{v}'" for v in c.values)
        count = f"select count(distinct {c.column}) from {t} where {c.column} not in ({listed})"
    return f"select '{c.test}' as test, '{c.table}' as table_name, '{c.column}' as column_name, ({count}) as failures"


def _checks_sql(checks, bodies: dict[str, str]) -> str:
    ctes = ", ".join(f"t_{n} as materialized ({b})" for n, b in bodies.items())
    names = {n: f"t_{n}" for n in bodies}
    return f"with {ctes} " + " union all ".join(_check_sql(c, names) for c in checks)


_RAW_BODIES = {lg.LEDGER: sample.ledger_sql(), **{t: sample.raw_sql(t) for t in sample.DERIVED}}
_KINDS = ("certificates", "recommendations")
_STAGED_BODIES = {
    lg.LEDGER: sample.ledger_sql(),
    **{spec.staging_name(d, k): _staged_sql(d, k) for d in spec.DOMAINS for k in _KINDS},
}


@query("checks_raw", _checks_sql(spec.RAW_CHECKS, _RAW_BODIES))
def checks_raw(spark, sf_dir):
    tables = {lg.LEDGER: sample.ledger(spark, sf_dir), **{t: sample.raw(spark, sf_dir, t) for t in sample.DERIVED}}
    tables[lg.LEDGER] = quality.checked_copies({lg.LEDGER: tables[lg.LEDGER]}, spec.RAW_CHECKS)[lg.LEDGER]
    return quality.run_checks(tables, spec.RAW_CHECKS)


@query("checks_staging", _checks_sql(spec.STAGING_CHECKS, _STAGED_BODIES))
def checks_staging(spark, sf_dir):
    tables = {spec.staging_name(d, k): staged(spark, sf_dir, d, k, narrow=True) for d in spec.DOMAINS for k in _KINDS}
    tables[lg.LEDGER] = sample.ledger(spark, sf_dir)
    return quality.run_checks(quality.checked_copies(tables, spec.STAGING_CHECKS), spec.STAGING_CHECKS)


#: Three runs: what they see of the batch axis, by the ledger's timestamps.
_CHECK_RUNS = ("audit_ts < '1996-06-01'", "audit_ts >= '1996-06-01' and audit_ts < '2000-01-01'", "audit_ts >= '2000-01-01'")


def _in_three_runs(log: CheckLog, runs) -> DataFrame:
    for fresh in runs:
        log.run(fresh)
    return log.results()


def _ledger_copy(spark, sf_dir) -> DataFrame:
    """The ledger, written once: every run asks for its files, table by table."""
    columns = ("audit_id", "filepath", "status", "audit_ts", "target_table")
    ledger = sample.ledger(spark, sf_dir).select(*columns)
    return quality.checked_copies({lg.LEDGER: ledger}, quality.not_null(lg.LEDGER, *columns))[lg.LEDGER]


@query("checks_raw_by_batch", _checks_sql(spec.RAW_CHECKS, _RAW_BODIES))
def checks_raw_by_batch(spark, sf_dir):
    """The checks of the raw layer after three loads, each looking at its own files' rows only."""
    mart, ledger = new_mart(spark, "check-log"), _ledger_copy(spark, sf_dir)

    def new_rows(when: str) -> dict[str, DataFrame]:
        mine = ledger.filter(when)
        raw = {t: sample.raw(spark, sf_dir, t).join(mine.filter(F.col("target_table") == t).select("audit_id"), "audit_id", "left_semi") for t in sample.DERIVED}
        return {lg.LEDGER: mine, **raw}

    return _in_three_runs(CheckLog(mart, "raw", spec.RAW_CHECKS), map(new_rows, _CHECK_RUNS))


@query("checks_staging_by_batch", _checks_sql(spec.STAGING_CHECKS, _STAGED_BODIES))
def checks_staging_by_batch(spark, sf_dir):
    """The checks of the staging layer after three loads; newer certificates take the place of older ones."""
    mart, ledger = new_mart(spark, "check-log"), _ledger_copy(spark, sf_dir)

    def new_rows(when: str) -> dict[str, DataFrame]:
        fresh = {lg.LEDGER: ledger.filter(when)}
        for d in spec.DOMAINS:
            for k in _KINDS:
                raw = sample.raw(spark, sf_dir, spec.raw_name(d, k), position=k == "certificates")
                rows = lg.join_audit(raw, ledger.filter(when), spec.raw_name(d, k))
                fresh[spec.staging_name(d, k)] = spec.latest_certificates(rows, narrow=True) if k == "certificates" else rows
        return fresh

    keyed = {spec.staging_name(d, "certificates"): spec.KEY for d in spec.DOMAINS}
    return _in_three_runs(CheckLog(mart, "staging", spec.STAGING_CHECKS, keyed), map(new_rows, _CHECK_RUNS))
