"""The two complete jobs, as dictionaries of lazy frames and as runs with outputs."""
