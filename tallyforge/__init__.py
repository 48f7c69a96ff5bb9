"""Request-log metering and analytics, written as Spark DataFrame operators."""
