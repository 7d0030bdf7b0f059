from changefeed.streaming.metrics import ProgressRecorder
from changefeed.streaming.pipeline import Pipeline
from changefeed.streaming.sinks import append_to_table, overwrite_batches, send_to_kafka

__all__ = ["Pipeline", "ProgressRecorder", "append_to_table", "overwrite_batches", "send_to_kafka"]
