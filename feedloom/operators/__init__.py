"""DataFrame operators: convert, prepare, route, merge, reconcile, ledger."""
