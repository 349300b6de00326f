"""Batch-mart operators: ledger, store, keys, history, KPIs, checks, calendar, BI."""
