"""Streaming.

The planner family is batch from end to end: there is no stream, watermark,
window or state in what it computes, so this package holds no operators.
Every job in ``slotplan`` is a pure DataFrame function, so a caller that wants
continuous refresh can run the same functions inside ``foreachBatch``.
"""
