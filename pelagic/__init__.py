"""pelagic: marine-observation analytics as Spark DataFrame operators.

Every operator takes DataFrames plus column names and returns a DataFrame
(or a Column for scalar helpers).  Nothing is collected to the driver except
bounded dimension sizes used to decide on a broadcast.
"""

from pelagic.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
