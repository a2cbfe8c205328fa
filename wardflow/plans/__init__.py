"""Assembled plans: the whole cohort run (O10) and stage metrics."""
