from wellgauge.functions.columns import calendar_parts, event_time, finite, text

__all__ = ["calendar_parts", "event_time", "finite", "text"]
