"""terrace: medallion analytics (landing → bronze → silver → gold → serving) on the public Spark API.

Every operator is a ``DataFrame -> DataFrame`` function; I/O lives in ``terrace.sources`` and the
multi-step jobs in ``terrace.plans``.
"""

__version__ = "0.1.0"
