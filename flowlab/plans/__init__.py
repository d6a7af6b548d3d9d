"""Whole jobs: test inputs, the stage layer, and the catalogue of named queries."""
