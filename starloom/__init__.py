"""Feature analytics for large collections of irregular time series, on Spark."""
