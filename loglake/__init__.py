"""loglake: a log lakehouse written as Spark DataFrame functions."""
