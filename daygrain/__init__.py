"""Per-user day-grain features, labels and scoring for event logs, on Spark."""
