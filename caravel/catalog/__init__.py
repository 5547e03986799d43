"""The source's catalog as DataFrames, typed schemas and DDL."""
