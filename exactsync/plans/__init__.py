"""Driver-side planning over schemas; the plan is a list of column expressions."""
