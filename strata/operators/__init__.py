"""DataFrame -> DataFrame operators: rules, quality, cleaning, enrichment,
joins, monitoring and quarantine handling."""
