"""Hourly well metrics from a log of JSON sensor messages, on Spark."""

from wellgauge.config import METRICS, JdbcTarget, JobConfig, Layout, MessageSource, ReportSink

__all__ = ["METRICS", "JdbcTarget", "JobConfig", "Layout", "MessageSource", "ReportSink"]
