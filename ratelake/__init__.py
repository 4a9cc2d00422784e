"""Multi-source currency-rate analytics expressed as Spark DataFrame jobs."""

from ratelake.config import EngineConfig, SourceSpec

__all__ = ["EngineConfig", "SourceSpec"]
