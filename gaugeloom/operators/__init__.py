"""DataFrame-to-DataFrame operators on metric points."""
