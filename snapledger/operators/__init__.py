"""DataFrame -> DataFrame operators, one module per layer."""

from snapledger.operators import asof, bronze, gold, quality, reports, silver

__all__ = ["asof", "bronze", "gold", "quality", "reports", "silver"]
