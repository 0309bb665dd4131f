"""The long-running queries and the metrics they report."""
