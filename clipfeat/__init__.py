"""Jobs that build and check clip-level feature stores on Spark."""
