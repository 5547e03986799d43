"""Operators on tables: constraints, sequences, copy-on-write DML, row hooks."""
