"""Row-wise relevance features on streaming query-product pairs.

The reference processes batches only; nothing here adds an operator. The
row-wise features (edit distances, lengths, common words and ratios) depend
on one row at a time, so they apply unchanged to a streaming DataFrame of
pairs joined with the static product tables (stream-static left joins, no
state). Features that need statistics over all rows (IDF, cosine) stay batch.
"""
from .features import feature_stream, write_feature_stream

__all__ = ["feature_stream", "write_feature_stream"]
