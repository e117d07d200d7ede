"""Feature tables and conversion scoring over impression logs, on Spark."""
