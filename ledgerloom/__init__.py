"""Commerce analytics on Spark: tables, reports, customer and demand models, experiments."""
