"""quarry: a PySpark-native engine for building text-training corpora from
source repositories and their documentation.

Every operator is a lazy ``DataFrame -> DataFrame`` function; relational work
stays inside Catalyst expressions and only model callables run in Python
workers (Arrow-batched ``mapInPandas``).
"""

__version__ = "0.1.0"
