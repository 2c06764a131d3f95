"""Product-analytics jobs over user-action logs, written as Spark DataFrame transforms."""
