"""Micro-batch loading of landing deliveries."""
