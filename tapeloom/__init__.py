"""Trade-message analytics on Spark: decode, upsert, expire and read market trades."""
