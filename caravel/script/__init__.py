"""SQL scripts: splitting, classification, execution, dry runs."""
