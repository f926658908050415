"""skein: code-graph and training-data analytics as Spark DataFrame jobs."""
