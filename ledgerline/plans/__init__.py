"""Query catalogue: one Spark plan per key, plus its SQL oracle where one exists."""
