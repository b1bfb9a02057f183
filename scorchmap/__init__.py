"""Fire-scar mapping from long stacks of satellite scenes, as Spark jobs."""
