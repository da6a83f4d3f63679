"""newstide: relate batches of news articles to market prices with Spark DataFrames.

Every operator is a pure ``DataFrame -> DataFrame`` function; the jobs in
``newstide.plans`` string them together.
"""

from newstide.session import build_session, prepare

__all__ = ["build_session", "prepare"]
