"""Registered queries of the document-table engine and their SQL oracles."""

from __future__ import annotations

from gridledger.plans.inputs import with_inputs
from gridledger.plans.oracles import ORACLES
from gridledger.plans.registry import QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {name: with_inputs(sql) for name, sql in ORACLES.items()}
