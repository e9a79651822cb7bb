"""DataFrame operators: casts, merges, dimensions, run ledger, metrics, analytics."""
