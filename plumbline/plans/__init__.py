"""Registered queries: each pairs a Spark plan over the given tables with equivalent SQL where SQL can say it."""
