"""Whole jobs: publish a report, convert scanner lines, collect an inventory; and the registered queries."""
