"""Product-catalog enrichment as Spark DataFrame operators."""
