"""The same answers in plain SQL, for comparison on another engine."""
