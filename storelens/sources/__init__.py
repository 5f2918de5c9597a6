"""Where data comes from and where snapshots land."""
