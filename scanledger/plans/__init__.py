"""Whole runs: raw export to written layers."""
