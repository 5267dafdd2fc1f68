"""Where events go."""

from tagloom.sinks.registry import HISTORICAL, REALTIME, SINKS, choose_sink

__all__ = ["HISTORICAL", "REALTIME", "SINKS", "choose_sink"]
