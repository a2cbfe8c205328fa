"""User-level operators of the cohort and time-block analytics."""
