"""Column builders: every one takes and returns ``pyspark.sql.Column``."""
