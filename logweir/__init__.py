"""Event-log analytics on Spark: logs of keyed JSON envelopes as tables and streams."""

__version__ = "0.1.0"
