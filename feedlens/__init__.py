"""feedlens — product analytics for a feed + messenger app, expressed as Spark plans.

Every operator takes DataFrames plus explicit dates/timestamps and returns a lazy
DataFrame; nothing reads the wall clock.
"""

from feedlens.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
