"""Daily price bars on Spark: landing, cleaning, storage, moving averages, market states."""
