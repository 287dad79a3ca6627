"""Reusable steps: who an account belongs to, and when its owner was last active.

No join carries a broadcast hint. The planner broadcasts a side only while its
measured size is under ``spark.sql.autoBroadcastJoinThreshold``, and falls back
to a shuffle join, whose skewed partitions adaptive execution splits.
"""
