"""monthledger: contract-revenue reconciliation as Spark DataFrame operators.

The package spreads monthly contracts over their claim months, prices every
month (annual price rises, pro-rata, VAT, tiered commission), applies the
disconnection / upgrade / non-billing rules, reconciles against the payment
feeds and reports the claims to raise.  Every step is a plain function that
takes and returns DataFrames (or Columns) built from Spark's own expressions.

Layout
------
``sources``    source schemas, readers with edge casts, writers, test fixtures
``functions``  Column -> Column building blocks (dates, money, price rises)
``operators``  DataFrame -> DataFrame business operators
``plans``      the end-to-end job and the query registry used by the harness
"""

from monthledger.plans.job import ReconSources, reconcile, run_reconciliation

__all__ = ["ReconSources", "reconcile", "run_reconciliation"]
