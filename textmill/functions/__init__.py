"""Column -> Column building blocks (pure Spark SQL expressions)."""
