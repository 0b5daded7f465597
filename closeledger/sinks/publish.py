"""Publish one extract to several targets.

The extract is computed once.  When the first target holds exactly this
run's output (a CSV folder or a Parquet path written in overwrite mode),
targets of the same format get its files byte for byte (``copy_folder``), and
targets of another format are written from what is stored there.  When it does
not (an append-mode table also holds earlier runs), the extract is checkpointed
to the cluster's checkpoint folder (``spark.checkpoint.dir``) and every target
is written from the checkpoint.  Either way all targets receive the same
rows, even though the load timestamp or a late fact row could differ
between two computations, and a lost executor never forces the extract to
be recomputed for the later targets.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import is_dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from closeledger.session import ensure_checkpoint_dir
from closeledger.sinks.copies import copy_folder


def same_format(a, b) -> bool:  # noqa: ANN001
    """Do two targets differ in nothing but their path?"""
    return type(a) is type(b) and is_dataclass(a) and hasattr(a, "path") and replace(b, path=a.path) == a


def publish(spark: SparkSession, df: DataFrame, targets: Sequence) -> list:
    """Write ``df`` to every target, computing it once; returns the targets."""
    if not targets:
        raise ValueError("no targets")
    first, rest = targets[0], list(targets[1:])
    if not rest:
        first.write(df)
    elif getattr(first, "holds_only_this_run", False):
        first.write(df)
        copies = [t.path for t in rest if same_format(first, t)]
        if copies:
            copy_folder(spark, first.path, copies)
        for t in rest:
            if not same_format(first, t):
                t.write(first.read(spark))
    else:
        ensure_checkpoint_dir(spark)
        stored = df.checkpoint(eager=True)
        for t in targets:
            t.write(stored)
    return list(targets)
