"""Transit demand analytics as Spark DataFrame operators."""
