"""Plans: the query catalogue over the fixture tables, model training, the full pipeline run."""
