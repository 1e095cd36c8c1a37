"""streaming of the ledgerline engine."""
