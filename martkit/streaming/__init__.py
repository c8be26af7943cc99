"""Streaming.

The original pipelines are daily full-refresh batches; they have no streaming
operator, watermark or state, so none is offered here. The ingest operators
(``sources.documents``) and the row-level operators are pure column
expressions: they apply unchanged to a streaming DataFrame from
``spark.readStream`` (see ``tests/test_streaming.py``).
"""
