"""Files, topics and tables the jobs read and write."""
