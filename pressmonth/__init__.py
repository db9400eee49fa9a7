"""Monthly news-agenda analytics on Spark."""
