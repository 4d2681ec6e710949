"""Bounds that decide between the one-task form and the distributed form of a step.

None of them drops rows: beyond a bound another exact way is taken.
"""

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
ONE_TASK_ROWS = 200_000
LOCAL_ROWS = 10_000
LOCAL_VECTORS = 2_000
BLOCK_ROWS = 4_096
