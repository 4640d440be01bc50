"""pitchmetrics: football match analytics as Spark DataFrame / Structured Streaming jobs.

Events and match records go in; per-player match metrics, minutes, contribution,
performance, rating histories, pair chemistry, career totals, player clusters,
age-rating regressions and answers to batches of requests come out.  Every
operator is a function from DataFrames to a DataFrame; nothing is collected to
the driver.
"""

__version__ = "0.1.0"
