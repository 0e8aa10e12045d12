"""Set-wise operators: ingest, alerts, state, diagnostics, monitoring."""
