"""Registered queries: every operator run over the given tables, each with an independent SQL check."""
