"""Registered queries, one module for each part of the inventory."""

from millrace.plans import aggregates, governed, ingestion, joins, projections, reports, scans, sinks, streams

ALL = (scans, sinks, projections, joins, aggregates, ingestion, governed, reports, streams)
