"""daybook: operators and jobs over dated, keyed personal observations on Spark.

Every operator is a ``DataFrame -> DataFrame`` function.  ``keys`` (for instance
``["user_id"]``) separates people; ``keys=()`` treats the table as one person's.
"""

from daybook.session import build_session

__all__ = ["build_session"]
