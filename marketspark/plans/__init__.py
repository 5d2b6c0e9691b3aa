"""Composite jobs: cleaning, indicators, marts, reports and the full refresh."""
