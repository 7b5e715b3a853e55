"""Whole reports: source tables and parameters in, finished result tables out."""
