"""Streaming forms. Most bounded operators take a streaming DataFrame as it is; this package
adds what needs state between micro-batches or an idempotent, transactional sink."""
