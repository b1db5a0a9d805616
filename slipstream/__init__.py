"""Race-event analytics as Spark DataFrame operators and batch plans."""
