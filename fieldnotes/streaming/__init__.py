"""Streaming: the reference has no stream operator (no watermark, window
or state). The only streamed operator here is the predict job's scoring,
run over a folder of arriving files (``scoring.score_stream``)."""
