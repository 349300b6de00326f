"""The certificate mart end to end on a few landed files."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from landed import FEB, JAN, dom, first_month, land_month, line, second_month
from ledgermart.operators import ledger as lg
from ledgermart.operators import quality
from ledgermart.operators.loader import purge_unaudited, rejected_rows
from ledgermart.operators.store import Mart
from ledgermart.plans import certificates as spec
from ledgermart.plans.pipeline import CertificateMart
from ledgermart.plans.schemas import FILE_COLUMNS


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    first_month(root)
    built = CertificateMart(Mart(spark, str(tmp_path_factory.mktemp("mart"))), reissues=True)
    built.run(str(root), "run-1", "2025-02-03 08:00:00", JAN)
    second_month(root)
    for run in ("run-2", "run-3"):  # the third run has nothing to do
        built.run(str(root), run, "2025-03-03 08:00:00", FEB)
    return built


def test_ledger_and_raw(built):
    ledger = lg.read_ledger(built.mart)
    assert ledger.count() == 12 and len(ledger.columns) == 14
    assert rows(lg.status_counts(ledger)) == [("LOADED", 12)]
    ids = sorted(int(r["audit_id"]) for r in ledger.collect())
    assert ids == list(range(1000, 1012))
    assert ledger.select("audit_ts").distinct().count() == 12
    raw = built.raw("raw_domestic_certificates")
    assert raw.count() == 5 and len(raw.columns) == 95
    got = lg.lineage(raw, ledger).filter("lmk_key = 'D4'").first()
    assert got["dag_run_id"] == "run-2" and got["filepath"].endswith("domestic_certificates_2025-02.csv")


def test_staging_is_newest_per_key_and_facts_keep_history(built):
    staged = built.staged("domestic", "certificates")
    assert {r["lmk_key"]: r["tenure"] for r in staged.collect()} == {
        "D1": "rented", "D2": "owned", "D3": None, "D4": None}
    fact = built.mart.table("fact_dom_energy")
    assert fact.count() == 5 and fact.filter("lmk_key = 'D1'").count() == 2
    assert len(fact.columns) == 45
    assert len(built.mart.table("fact_disp_energy").columns) == 31
    assert len(built.mart.table("fact_non_dom_energy").columns) == 24
    assert built.mart.table("fact_dom_recom").count() == 4


def test_property_history(built):
    dim = built.mart.table("dim_property")
    by_key = {r["property_identity_key"]: r["n"] for r in
              dim.groupBy("property_identity_key").agg(F.count("*").alias("n")).collect()}
    assert by_key["1"] == 2 and by_key["2"] == 1 and by_key["4"] == 1 and by_key["9"] == 1
    closed = dim.filter("valid_to is not null").first()
    assert closed["tenure"] == "owned" and str(closed["valid_to"]) == "2025-03-03 08:00:00"
    current = built.property_current()
    assert current.count() == 6 and current.filter("property_identity_key = '1'").first()["tenure"] == "rented"


def test_kpis(built):
    first, second = built.kpi("kpi_dom_rating").collect()
    assert (first["pct_with_mains_gas"], first["pct_high_rating"]) == (100.0, 100.0)
    assert first["monthly_avg_co2_tonnes"] == 4.0 and first["monthly_avg_co2_per_m2"] == 0.13
    assert first["monthly_avg_efficiency"] is None and second["monthly_avg_efficiency"] == 50.0
    # older rows keep the global figures of their own run
    assert first["global_avg_efficiency"] is None and second["global_avg_efficiency"] == 50.0
    recs = built.kpi("kpi_dom_recom").collect()
    assert [r["total_recommendations"] for r in recs] == [3, 1]
    assert [r["global_total_recommendations"] for r in recs] == [3, 4]
    assert recs[0]["pct_low_cost_range"] == 33.33 and recs[1]["global_pct_medium_cost_range"] == 25.0
    split = built.kpi("kpi_non_dom_recom").collect()
    assert [r["payback_type"] for r in split] == ["ALL", "long", "short"] * 2


def test_incremental_kpis_equal_a_rebuild(built):
    for name, fact in spec.FACT_OF_KPI.items():
        rebuilt = spec.kpi_table(name, built.mart.table(fact))
        newest = built.mart.table(fact).agg(F.max("audit_ts")).first()[0]
        # rows of the newest run carry today's globals
        latest = built.kpi(name).filter(F.col("audit_ts") == F.lit(newest))
        assert rows(latest) == rows(rebuilt.filter(F.col("audit_ts") == F.lit(newest))), name


def test_bitmaps_give_the_same_kpis(built, spark, tmp_path):
    own = CertificateMart(Mart(spark, str(tmp_path / "mart")), bitmaps=True)
    for fact in set(spec.FACT_OF_KPI.values()):
        own.mart.append_new(fact, built.mart.table(fact))
    own.kpis()
    for name in spec.METRICS:
        assert rows(own.kpi(name)) == rows(spec.kpi_table(name, built.mart.table(spec.FACT_OF_KPI[name]))), name
    assert own.mart.exists("kpi_dom_recom_partials_values")


def test_refreshed_globals_equal_a_rebuild(built):
    built.kpis(refresh_globals=True)
    for name, fact in spec.FACT_OF_KPI.items():
        assert rows(built.kpi(name)) == rows(spec.kpi_table(name, built.mart.table(fact))), name


def test_there_are_65_checks(built):
    assert len(spec.RAW_CHECKS) == 31 and len(spec.STAGING_CHECKS) == 34
    strict = quality.run_checks(
        {lg.LEDGER: lg.read_ledger(built.mart), **{t: built.raw(t) for t in FILE_COLUMNS}}, spec.raw_checks())
    failed = strict.filter("failures > 0").collect()
    assert [(r["test"], r["table_name"], r["failures"]) for r in failed] == [
        ("unique", "raw_domestic_certificates", 1)]  # D1 came twice


def bad_mart(spark, tmp_path):
    first_month(tmp_path)
    target = tmp_path / "raw" / "certificates" / "domestic" / f"domestic_certificates_{JAN}.csv"
    table = "raw_domestic_certificates"
    target.write_text(target.read_text() + line(table, lmk_key="D9", uprn="none") + "\n"
                      + line(table, lmk_key="D8", lodgement_date="someday") + "\n")
    return CertificateMart(Mart(spark, str(tmp_path / "mart")))


def test_bad_rows_are_counted_and_block_the_gate(spark, tmp_path):
    built = bad_mart(spark, tmp_path)
    results = built.load(str(tmp_path), "r", JAN)
    with pytest.raises(lg.LoadGateError):
        lg.gate_loads(results)
    entry = lg.read_ledger(built.mart).filter("target_table = 'raw_domestic_certificates'").first()
    assert entry["status"] == "PARTIALLY_LOADED"
    assert (entry["rows_parsed"], entry["rows_loaded"], entry["errors_seen"]) == (5, 3, 2)
    assert entry["first_error_column_name"] == "uprn" and "'none'" in entry["first_error"]
    assert entry["first_error_line"] == 5
    assert built.raw("raw_domestic_certificates").count() == 3
    assert rejected_rows(built.mart, "raw_domestic_certificates").count() == 2
    assert built.load(str(tmp_path), "again", JAN).isEmpty()  # known to the ledger, whatever its status
    with pytest.raises(quality.CheckFailure, match="accepted_values"):
        built.transform("2025-02-03 08:00:00")

    first_month(tmp_path)  # the corrected file
    results = built.load(str(tmp_path), "fixed", JAN, reload=[entry["filepath"]])
    assert results.count() == 1
    lg.gate_loads(results)
    ledger = lg.read_ledger(built.mart)
    assert ledger.count() == 6 and rows(lg.status_counts(ledger)) == [("LOADED", 6)]
    assert built.raw("raw_domestic_certificates").count() == 3
    quality.gate(built.check_raw())
    assert len(purge_unaudited(built.mart, "raw_domestic_certificates")) == 2  # the earlier load's two parts


def test_empty_load_fails_the_gate(spark, tmp_path, mart):
    first_month(tmp_path)
    results = CertificateMart(mart).load(str(tmp_path), "r", "2031-01")
    with pytest.raises(lg.LoadGateError, match="no file"):
        lg.gate_loads(results)


def test_crash_before_the_ledger_row(spark, tmp_path, mart, monkeypatch):
    first_month(tmp_path)
    built = CertificateMart(mart)
    append = lg.append_ledger

    def crash(*args):
        raise KeyboardInterrupt  # not an Exception: the process dies here

    monkeypatch.setattr(lg, "append_ledger", crash)
    with pytest.raises(KeyboardInterrupt):
        built.load(str(tmp_path), "r1", JAN)
    monkeypatch.setattr(lg, "append_ledger", append)
    table = "raw_display_certificates"
    assert mart.exists(table) and built.raw(table).count() == 0
    assert lg.orphan_rows(mart.table(table), lg.read_ledger(mart)).count() == 1
    assert purge_unaudited(mart, table) == ["1000"]
    assert mart.table(table).count() == 0
    lg.gate_loads(built.load(str(tmp_path), "r2", JAN))
    assert built.raw(table).count() == 1


def test_one_unreadable_file_does_not_hold_back_the_rest(spark, tmp_path, mart):
    first_month(tmp_path)
    folder = tmp_path / "raw" / "certificates" / "domestic"
    (folder / "domestic_certificates_2025-01.csv.gz").write_bytes(b"\x1f\x8b not a gzip file")
    results = {r["filepath"].rsplit("/", 1)[1]: r["status"] for r in
               CertificateMart(mart).load(str(tmp_path), "r", JAN).collect()}
    assert results["domestic_certificates_2025-01.csv.gz"] == "FAILED"
    assert results["domestic_certificates_2025-01.csv"] == "LOADED" and len(results) == 7
    assert lg.read_ledger(mart).count() == 6


def test_a_run_with_an_earlier_timestamp_loses_nothing(spark, tmp_path):
    built = CertificateMart(Mart(spark, str(tmp_path / "mart")), reissues=True)
    first_month(tmp_path)
    built.run(str(tmp_path), "january", "2025-03-03 08:00:00", JAN)
    second_month(tmp_path)
    built.run(str(tmp_path), "february", "2025-02-03 08:00:00", FEB)
    raw = built.raw("raw_domestic_certificates").count()
    assert built.mart.table("stg_domestic_certificates").count() == raw == 5
    assert built.mart.table("fact_dom_energy").count() == 5
    times = [r["audit_ts"] for r in lg.read_ledger(built.mart).orderBy(F.col("audit_id").cast("int")).collect()]
    assert times == sorted(times) and len(set(times)) == 12


def test_reloaded_file_replaces_its_batches_in_all_layers(spark, tmp_path):
    built = CertificateMart(Mart(spark, str(tmp_path / "mart")), reissues=True)
    first_month(tmp_path)
    built.run(str(tmp_path), "first", "2025-02-03 08:00:00", JAN)
    names = ("stg_domestic_recommendations", "fact_dom_recom", "stg_domestic_certificates", "fact_dom_energy")
    counts = lambda: [built.mart.table(n).count() for n in names] + [built.kpi("kpi_dom_recom").count()]
    before = counts()
    again = [r["filepath"] for r in lg.read_ledger(built.mart).filter("target_table like 'raw_domestic%'").collect()]
    lg.gate_loads(built.load(str(tmp_path), "again", JAN, run_ts="2025-02-04 08:00:00", reload=again))
    built.transform("2025-02-04 08:00:00")
    assert counts() == before
    assert lg.read_ledger(built.mart).count() == 6
