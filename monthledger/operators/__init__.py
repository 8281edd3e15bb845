"""DataFrame -> DataFrame business operators of the reconciliation."""
