"""Trip and mobility analytics as Spark DataFrame functions."""
