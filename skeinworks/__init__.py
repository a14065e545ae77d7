"""skeinworks: a Spark-first analytics engine for curriculum-style knowledge graphs."""

__version__ = "0.1.0"
