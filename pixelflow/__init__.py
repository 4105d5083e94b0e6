"""pixelflow: ad-response analytics as Spark DataFrame jobs.

Five batch jobs over ad logs (impression counts, fractional conversion
credit, smoothed conversion rate, per-cookie labelled impression
sequences, click-through leaves), written with built-in Spark SQL
expressions, broadcast joins of size-checked lookup tables, aggregations
and window functions.
"""

__version__ = "0.1.0"
