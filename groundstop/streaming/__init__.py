"""Structured Streaming jobs: the prediction log and late-arriving labels."""

from groundstop.streaming.monitor_stream import label_join_stream, late_label_stream, prediction_log_stream

__all__ = ["label_join_stream", "late_label_stream", "prediction_log_stream"]
