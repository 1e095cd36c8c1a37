"""plans of the ledgerline engine."""
