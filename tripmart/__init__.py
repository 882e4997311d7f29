"""Trip-record medallion pipeline expressed with PySpark DataFrames."""

from tripmart.config import Rules, spark_session

__all__ = ["Rules", "spark_session"]
