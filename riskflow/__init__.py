"""riskflow: Spark jobs that turn a wide incident table into a checked, scored risk model.

Every operator takes and returns Spark DataFrames, with column names as
parameters. Nothing that grows with the data passes through the driver.
"""

from riskflow.session import build_session

__all__ = ["build_session"]
