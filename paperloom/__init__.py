"""paperloom: corpus preparation and corpus analytics as Spark DataFrame operators."""
