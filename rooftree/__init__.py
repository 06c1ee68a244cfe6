"""Rooftree: Spark operators for listing catalogs (intake, quality, dedupe, state, reconcile)."""
