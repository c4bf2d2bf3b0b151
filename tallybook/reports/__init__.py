"""Registered reports: every operator on the driver tables, with its SQL check."""
