"""ideaweave: corpus mining of short texts on Spark (DataFrame / SQL / Structured Streaming)."""

from .config import DEFAULT_CONFIG, PipelineConfig

__all__ = ["DEFAULT_CONFIG", "PipelineConfig"]
