"""DataFrame operators: enrichment, quality, aggregation, ranking, set-relative measures."""
