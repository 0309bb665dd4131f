"""The answers: curated views over the stored tables, and the table writers and readers."""
