"""Whole jobs: apply a contract, apply many, lint a data dictionary."""
