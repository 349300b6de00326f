"""The certificate mart, layer by layer, on stored tables.

Staging certificates are kept as an append-only log by batch. The upsert the mart
needs — the newest row per key — is applied on read over the batches a step is
about to process, so no step rewrites or rescans old batches.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermart.functions.dates import batch_id
from ledgermart.operators import kpi, quality
from ledgermart.operators.bitmaps import append_bitmaps
from ledgermart.operators.check_log import CheckLog
from ledgermart.operators.incremental import newer_than
from ledgermart.operators.ledger import FAILED, LEDGER, gate_loads, join_audit, read_ledger
from ledgermart.operators.loader import load_files, raw_table
from ledgermart.operators.parallel import run_together
from ledgermart.operators.replaced import ReplacedTable
from ledgermart.operators.store import Mart
from ledgermart.plans import certificates as spec
from ledgermart.plans.schemas import FILE_COLUMNS, file_schema
from ledgermart.sources.csv import BLOCK, SEQ
from ledgermart.sources.files import list_files, select_batch

KINDS = ("certificates", "recommendations")
STAMP_FIELDS = (T.StructField("audit_id", T.StringType()), T.StructField("load_ts", T.TimestampType()))
PLACE_FIELDS = (T.StructField(BLOCK, T.LongType()), T.StructField(SEQ, T.LongType()))
DELTA, DIMENSION = "delta_property", "dim_property"


class CertificateMart:
    """One mart: load, check, stage, history, facts, KPIs."""

    def __init__(self, mart: Mart, reissues: bool = False, bitmaps: bool = False, checks_by_batch: bool = False):
        """``bitmaps`` keeps the distinct values of KPI partials as bitmaps over numbered values.

        With ``checks_by_batch`` the checks of raw and staging look at new batches only, and
        what they have to know of older ones is kept.
        """
        self.mart, self.spark = mart, mart.spark
        self.schemas = {t: file_schema(t) for t in FILE_COLUMNS}
        self.reissues, self.bitmaps, self.checks_by_batch = reissues, bitmaps, checks_by_batch
        keyed = {spec.staging_name(d, "certificates"): spec.KEY for d in spec.DOMAINS}
        self.raw_log = CheckLog(mart, "checks_raw", spec.raw_checks(reissues))
        self.staging_log = CheckLog(mart, "checks_staging", spec.STAGING_CHECKS, keyed)

    # -- raw -------------------------------------------------------------------

    def load(self, landing: str, run_id: str, month_tag: str | None = None, paths: DataFrame | None = None,
             run_ts: str | None = None, reload: Sequence[str] = (), multiline: bool | None = None) -> DataFrame:
        """Loads one month's (or the listed) files below the landing folder.

        ``reload`` names files to load again, such as a corrected one that was only
        partly loaded before. What later layers made of their earlier batches is taken
        out with them; the next ``transform`` builds it from the new ones. The property
        history keeps what it has seen.
        """
        files = select_batch(list_files(self.spark, landing), month_tag, paths)
        return self.load_listed(files, run_id, run_ts, reload, multiline)

    def load_listed(self, files: DataFrame, run_id: str, run_ts: str | None = None, reload: Sequence[str] = (),
                    multiline: bool | None = None) -> DataFrame:
        before = read_ledger(self.mart).filter(F.col("filepath").isin(list(reload)))
        replaced = before.select("filepath", "target_table", batch_id(F.col(spec.BATCH)).alias("part")).collect() if reload else []
        results = load_files(self.mart, files, self.schemas, run_id, run_ts, reload, multiline)
        if replaced:
            loaded = {r["filepath"] for r in results.filter(F.col("status") != FAILED).collect()}
            self._drop_batches([(r["target_table"], r["part"]) for r in replaced if r["filepath"] in loaded])
        return results

    def _drop_batches(self, batches: Sequence[tuple[str, str]]) -> None:
        """Takes batches of raw tables out of staging, facts, KPI partials and KPIs; kept check results begin anew."""
        for log in (self.raw_log, self.staging_log):
            log.reset()
        for domain in spec.DOMAINS:
            for kind in KINDS:
                gone = [part for table, part in batches if table == spec.raw_name(domain, kind)]
                fact = spec.fact_name(domain, kind)
                kpis = [name for name, of in spec.FACT_OF_KPI.items() if of == fact]
                for name in (spec.staging_name(domain, kind), fact, *(f"{k}_partials" for k in kpis)):
                    if gone and self.mart.exists(name):
                        self.mart.drop_parts(name, gone)
                for name in kpis:
                    self._kpi_table(name).drop(gone)

    def raw(self, table: str, ledger: DataFrame | None = None, position: bool = False) -> DataFrame:
        """Audited raw rows: those whose audit id the ledger lists for this table."""
        known = (read_ledger(self.mart) if ledger is None else ledger).filter(F.col("target_table") == table)
        ids = [r["audit_id"] for r in known.select("audit_id").collect()]
        if not self.mart.exists(table):
            place = PLACE_FIELDS if position else ()
            return self.spark.createDataFrame([], T.StructType([*self.schemas[table].fields, *STAMP_FIELDS, *place]))
        return raw_table(self.mart, table, self.schemas[table], ids, position)

    def check_raw(self) -> DataFrame:
        if self.checks_by_batch:
            fresh, high = self._new_ledger(self.raw_log)
            return self.raw_log.run({LEDGER: fresh, **{t: self.raw(t, fresh) for t in self.schemas}}, high)
        tables = {LEDGER: read_ledger(self.mart), **{t: self.raw(t) for t in self.schemas}}
        return quality.run_checks(tables, spec.raw_checks(self.reissues))

    def _new_ledger(self, log: CheckLog) -> tuple[DataFrame, dict[str, str]]:
        """Ledger rows that the log has not seen, and how far the ledger then has been seen."""
        ledger, seen = read_ledger(self.mart), log.highs().get(LEDGER)
        newest = ledger.agg(F.max(spec.BATCH).cast("string")).first()[0]
        return ledger.filter(newer_than(spec.BATCH, seen)), {LEDGER: newest} if newest else {}

    # -- staging ---------------------------------------------------------------

    def stage(self) -> None:
        """Adds the new batches of all six raw tables to staging."""
        ledger = read_ledger(self.mart)

        def add(domain: str, kind: str) -> None:
            raw, staged = spec.raw_name(domain, kind), spec.staging_name(domain, kind)
            after = self.mart.watermark(staged)
            fresh = ledger.filter(F.col("target_table") == raw)
            if after is not None:
                fresh = fresh.filter(F.col(spec.BATCH) > F.lit(after))
            rows = self.raw(raw, fresh, position=kind == "certificates")
            self.mart.append_new(staged, join_audit(rows, fresh), spec.BATCH)

        run_together(self.spark, [partial(add, d, k) for d in spec.DOMAINS for k in KINDS])

    def staged(self, domain: str, kind: str, after: str | None = None, narrow: bool = False) -> DataFrame:
        """A staging table as readers see it, optionally only its newer batches; ``narrow`` to read few columns."""
        rows = self.mart.table(spec.staging_name(domain, kind), after)
        return spec.latest_certificates(rows, narrow=narrow) if kind == "certificates" else rows

    def check_staging(self) -> DataFrame:
        if self.checks_by_batch:
            seen, (ledger, high) = self.staging_log.highs(), self._new_ledger(self.staging_log)
            names = {spec.staging_name(d, k): (d, k) for d in spec.DOMAINS for k in KINDS}
            fresh = {n: self.staged(*names[n], seen.get(n), narrow=True) for n in names}
            return self.staging_log.run({LEDGER: ledger, **fresh}, high | {n: self.mart.watermark(n) for n in names})
        tables = {spec.staging_name(d, k): self.staged(d, k, narrow=True) for d in spec.DOMAINS for k in KINDS}
        tables = quality.checked_copies(tables, spec.STAGING_CHECKS)
        return quality.run_checks({LEDGER: read_ledger(self.mart), **tables}, spec.STAGING_CHECKS)

    # -- property history --------------------------------------------------------

    def snapshot(self, run_ts: str) -> DataFrame:
        """Delta of the properties since the last snapshot, then one history step."""
        done = self.mart.high(DIMENSION)
        high = max((self.mart.watermark(spec.staging_name(d, "certificates")) for d in spec.DOMAINS))
        staged = [self.staged(d, "certificates", done, narrow=True) for d in spec.DOMAINS]
        delta = self.mart.write_full(DELTA, spec.property_delta(staged))
        return self.mart.write_snapshot(DIMENSION, delta, spec.PROPERTY_KEY, [spec.PROPERTY_STATE], run_ts, high)

    def property_current(self) -> DataFrame:
        return self.mart.current(DIMENSION)

    # -- facts and KPIs ----------------------------------------------------------

    def facts(self) -> None:
        def add(domain: str, kind: str) -> None:
            name, keyed = spec.fact_name(domain, kind), kind == "certificates"
            after = self.mart.watermark(name)
            rows = self.staged(domain, kind, after)
            fact = spec.fact_energy(rows, domain) if keyed else spec.fact_recommendations(rows)
            # certificates are looked up by property: a batch's rows are in its order
            self.mart.append_new(name, fact, spec.BATCH, cluster=[spec.PROPERTY_KEY] if keyed else ())

        run_together(self.spark, [partial(add, d, k) for d in spec.DOMAINS for k in KINDS])

    def kpis(self, refresh_globals: bool = False) -> None:
        """Adds the new batches' partials, then the KPI rows of those batches.

        Whole-history figures come from the stored partials, so old facts are not
        read again. Older KPI rows keep the figures of the run that wrote them,
        unless ``refresh_globals``.
        """

        def add(name: str, metrics: list[kpi.Metric]) -> None:
            split, partials = spec.SPLIT_BY.get(name), f"{name}_partials"
            fact = self.mart.table(spec.FACT_OF_KPI[name], self.mart.watermark(partials))
            if self.bitmaps and any(m.distinct for m in metrics):
                stored = append_bitmaps(self.mart, partials, fact, spec.BATCH, metrics, split)
            else:
                stored = self.mart.append_new(partials, kpi.kpi_partials(fact, spec.BATCH, metrics, split), spec.BATCH)
            missing, since = self._kpi_table(name).since(self.mart.batches(partials))
            if missing or refresh_globals:
                report = kpi.kpi_from_partials(stored, spec.BATCH, metrics, split, None if refresh_globals else since)
                self._kpi_table(name).replace(report, spec.BATCH)

        run_together(self.spark, [partial(add, n, m) for n, m in spec.METRICS.items()])

    def _kpi_table(self, name: str) -> ReplacedTable:
        return ReplacedTable(self.spark, f"{self.mart.root}/{name}")

    def _kpi_rows(self, name: str) -> DataFrame:
        """The rows of a KPI table, none before the first batch."""
        table = self._kpi_table(name)
        return table.table() if table.exists() else spec.kpi_table(name, self.mart.table(spec.FACT_OF_KPI[name]).limit(0))

    def kpi(self, name: str) -> DataFrame:
        """A KPI table in its reading order."""
        split = spec.SPLIT_BY.get(name)
        return self._kpi_rows(name).orderBy(spec.BATCH, *([split] if split else []))

    def check_presentation(self) -> DataFrame:
        names = {c.table for c in spec.PRESENTATION_CHECKS}
        tables = {n: self._kpi_rows(n) if n in spec.METRICS else self.mart.table(n) for n in names}
        return quality.run_checks(tables, spec.PRESENTATION_CHECKS)

    # -- all of it ---------------------------------------------------------------

    def transform(self, run_ts: str) -> None:
        """Everything after the load, with the checks as gates between layers."""
        quality.gate(self.check_raw())
        self.stage()
        quality.gate(self.check_staging())
        self.snapshot(run_ts)
        self.facts()
        self.kpis()
        quality.gate(self.check_presentation())

    def run(self, landing: str, run_id: str, run_ts: str, month_tag: str | None = None) -> None:
        """Load and transform one batch. Without new files nothing is done."""
        results = self.load(landing, run_id, month_tag, run_ts=run_ts)
        if results.isEmpty():
            return
        gate_loads(results)
        self.transform(run_ts)
