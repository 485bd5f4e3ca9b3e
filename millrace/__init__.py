"""millrace: dataset quality, duplicate analysis and leakage-safe splitting on Spark."""
