"""Sinks (K1-K3, T6)."""

from .csv import write_files, write_partitioned_csv, write_single_csv

__all__ = ["write_files", "write_partitioned_csv", "write_single_csv"]
