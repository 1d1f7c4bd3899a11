"""DataFrame-to-DataFrame operators without knowledge of any particular table."""
