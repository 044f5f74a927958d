"""tickwise: PySpark-native market-data analytics."""
