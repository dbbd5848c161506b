"""Supply-continuity analytics as lazy Spark plans."""
