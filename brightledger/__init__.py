"""Marketing and commerce analytics jobs written as Spark DataFrame functions."""
