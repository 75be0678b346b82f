"""Job-posting lakehouse on Spark: landing -> bronze -> silver -> gold -> serving."""
