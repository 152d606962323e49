"""tierlake: a three-layer e-commerce event lake on PySpark.

Topics (JSON messages) -> raw -> clean -> metrics -> user profiles -> read queries,
as DataFrame functions that batch jobs and Structured Streaming jobs share.
"""

__version__ = "0.1.0"
