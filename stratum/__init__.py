"""stratum: layered listing analytics on Spark.

Bronze (landed files) -> silver (typed staging) -> intermediate (valid /
rejected split) -> gold (star schema), plus data-quality checks, coverage
audits, per-role row access and rule-based listing labels.  Every operator
is a ``DataFrame -> DataFrame`` function; nothing is pulled to the driver.
"""

__version__ = "0.1.0"
