"""Loads, dashboards and reports composed of the operators."""
