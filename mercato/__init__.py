"""mercato: retail analytics and feature preparation on Spark.

Every operator is a function from DataFrames to a DataFrame. Nothing is
collected to the driver; statistics that feed later columns travel as
one-row DataFrames joined back by broadcast (a one-row side has a proven
size bound).
"""

from mercato.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
