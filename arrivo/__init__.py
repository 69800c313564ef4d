"""arrivo: monthly demand analytics on Spark DataFrames.

Land several arrival sources with different periods and column names, bring them
to one month x origin x entry-point fact, join monthly side series (quotes,
search interest), add median flags and calendar features, then profile, model
and score the result.  Every public transform takes and returns DataFrames.
"""

from arrivo.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
