"""Parameters, session settings, job wiring and the query catalogue."""
