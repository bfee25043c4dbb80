"""Models: raw to staged tables, staged tables to marts, marts to views."""
