"""martforge: a Spark-native sales mart.

Builds a star schema (calendar, product, customer, seller and location
dimensions plus an invoice-item fact) from transactional sales tables,
exports a month-partitioned Parquet lake, aggregates monthly and
geographic data marts and serves the reporting queries on top, all as
DataFrame plans that Catalyst and AQE schedule.
"""

from martforge.config import PipelineConfig, FIXTURE_CONFIG

__all__ = ["PipelineConfig", "FIXTURE_CONFIG"]
