"""Customer analytics as PySpark DataFrame pipelines.

Raw customer, order, item, event, campaign and ticket tables become staging
views, per-customer aggregates, marts with recency/frequency/monetary scores,
and model scores, with data-quality reports at each layer.
"""

from patronlens.session import create_session

__all__ = ["create_session"]
