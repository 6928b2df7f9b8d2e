"""kaiji: disclosure-data operators on Spark DataFrames.

Every operator is a plain function ``DataFrame(s), params -> DataFrame``.
Nothing is collected to the driver; all work is planned by Catalyst and
executed as Spark jobs.
"""

__version__ = "0.1.0"
