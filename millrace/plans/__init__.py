"""Registered queries: a Spark job on the given tables and, where one exists, its check in SQL."""

from millrace.plans.registry import all_queries

__all__ = ["all_queries"]
