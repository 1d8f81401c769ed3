"""Property-records analytics on PySpark: county sources to unified records, reports and takeoffs."""
