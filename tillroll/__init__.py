"""Retail order lake on Spark: cleaning, quality gate, warehouse tables, reports, order events."""
