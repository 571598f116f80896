"""stayframe: cohort studies on event data, expressed as Spark DataFrame plans.

Every operator takes DataFrames and returns a lazy DataFrame; nothing is
collected to the driver except aggregate-size reports.
"""

from stayframe.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
