"""DataFrame -> DataFrame jobs: cleaning, enrichment, joins, tables, windows, metrics, forecast, dashboard."""
