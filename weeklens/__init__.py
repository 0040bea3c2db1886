"""Weekly retail demand analytics as Spark DataFrame transformations."""
