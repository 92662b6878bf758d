"""Fitted model, end-to-end pipeline and the named query catalogue."""
