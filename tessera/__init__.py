"""Population-relatedness analytics and large-table operators on PySpark."""
