"""operators of the ledgerline engine."""
