"""Registered queries, each beside the SQL an independent engine answers it with."""

from __future__ import annotations

from ledgermart.plans.queries import bi, certificates, checks, files, history, kpis, tables  # noqa: F401
from ledgermart.plans.queries.registry import ORACLES, QUERIES  # noqa: F401
