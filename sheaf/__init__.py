"""sheaf: a Spark-first engine that turns paged documents into a clean question dataset."""
