"""Operators for preparing training data: tokens, packing, search, quality, chat, language,
near copies, personal data and hosts. Nothing outside this folder imports it.

Per-row Python runs inside Arrow batches that Spark partitions; batches are cut to a few
hundred rows before any text becomes a Python string, so memory does not follow the size
of a partition.
"""
