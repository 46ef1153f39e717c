"""Market-bar analytics and corpus preparation as PySpark DataFrame operators."""
