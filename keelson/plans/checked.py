"""Loads every module that registers checked queries."""

from keelson.plans import q_ingest, q_merge, q_relational, q_scalar  # noqa: F401
