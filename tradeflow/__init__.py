"""Monthly trade-flow analytics as plain Spark DataFrame operators."""
