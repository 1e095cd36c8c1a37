"""sources of the ledgerline engine."""
