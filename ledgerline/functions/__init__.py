"""functions of the ledgerline engine."""
