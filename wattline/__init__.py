"""Half-hourly energy analytics as Spark DataFrame operators."""
