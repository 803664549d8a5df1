"""martloom: a near-real-time retail warehouse as Spark DataFrame jobs."""
