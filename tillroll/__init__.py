"""tillroll: retail metrics on Spark (reports, their datasets, checks, sinks)."""

__all__ = ["plans", "operators", "sources", "functions"]
