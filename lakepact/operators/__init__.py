"""Operators: typing, checks, report, gate, evolution, publish, registry diff."""
