"""Structured Streaming: running category totals over arriving CSV files."""

from trendstats.streaming.totals import category_totals, read_trending_stream, start_category_totals

__all__ = ["category_totals", "read_trending_stream", "start_category_totals"]
