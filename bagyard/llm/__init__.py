"""Operators for training-data pipelines; optional, nothing else in the library imports them."""

import ctypes

import pyarrow as pa


def _return_freed_blocks() -> None:
    """Let this process give freed arrays of a megabyte and more back to the system.

    glibc raises its own threshold with every large array that is freed, and Arrow's pool keeps what it
    once had; a worker that lives for a whole job would then hold the peak of all its tasks."""
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 1 << 20)  # M_TRIM_THRESHOLD
    except (OSError, AttributeError):  # another C library
        pass


_return_freed_blocks()
