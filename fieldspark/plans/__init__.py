"""Model registry, the models, run ledger and the query catalogue."""
