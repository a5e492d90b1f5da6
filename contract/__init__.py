"""Checked queries: every operator run over the supplied tables, next to its SQL oracle."""
