"""Plans: the layered pipeline, KPI queries, measures and the query registry."""
