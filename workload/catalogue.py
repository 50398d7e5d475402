"""Importing this module registers every query."""

from workload import delivery, edges, flows, measures, scans, sending, streams  # noqa: F401
