"""tillwise: point-of-sale bundle analytics expressed as Spark DataFrame plans.

Every public function takes and returns DataFrames (or Columns).  Nothing is
collected to the driver in a core path; per-series numeric work that Spark's
built-ins cannot express runs in grouped pandas functions.
"""

__all__ = ["session", "config"]
