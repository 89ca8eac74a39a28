"""snapledger: snapshot-ledger analytics for late, redelivered change events on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from the
DataFrame / Spark SQL API; storage I/O lives in :mod:`snapledger.sources.storage`
and end-to-end daily runs in :mod:`snapledger.plans.daily`.
"""

from snapledger.model import EXTRA_INFO, PRODUCT_ITEM, PURCHASE, Entity

__all__ = ["Entity", "PURCHASE", "PRODUCT_ITEM", "EXTRA_INFO"]
