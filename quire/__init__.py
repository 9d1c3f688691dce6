"""quire: cited-document analytics as Spark DataFrame operators.

A corpus of texts, conversations, HTML pages and relational records becomes one
long ``nodes`` table (one row per typed document node, keyed by ``doc_id``) and a
``docs`` table (one row per document).  Every operator is a function from
DataFrames to a DataFrame built from Spark SQL expressions, joins and windows.
"""

from quire.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
__version__ = "0.1.0"
