"""Registry analytics as Spark jobs: load, clean, check, summarise, report."""
