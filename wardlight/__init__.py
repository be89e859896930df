"""wardlight: surveillance-event analytics written as Spark DataFrame jobs."""
