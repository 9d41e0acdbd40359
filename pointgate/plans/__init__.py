"""Whole runs: source -> points -> gate -> outputs, and the registered queries."""
