"""Pipelines: staging, enrichment, marts, reports and the end-to-end job."""
