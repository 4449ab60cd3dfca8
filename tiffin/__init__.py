"""Food-delivery lakehouse analytics expressed as Spark DataFrame, SQL and streaming operators."""
