"""Benchmark decontamination by size-partitioned containment MinHash.

Benchmark items are partitioned by the size class (power of two) of their
shingle set.  An item's sketch holds its k smallest shingle hashes; k belongs
to the class and is the number of shingles an item may miss plus one
(``q - ceil(t * q) + 1`` at the class's upper size).  A document that contains
at least the share ``t`` of an item's shingles therefore holds at least one of
its sketch hashes: the search has no false negatives, however long the
document.  Each hit is verified by the exact containment of the word shingles.

The benchmark is the stated query set.  It is taken in blocks of at most
``BLOCK`` bytes, each broadcast, against whole documents in one scan without a
shuffle.

Defined cases: a null or empty text, and an item without words, match nothing;
an item of fewer than five words is one shingle of all its words and is looked
for as such; an item id is reported as it stands, null too; repeated rows each
get their own result rows; empty tables give no rows; further columns are
ignored, and kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from closeledger.llm.common import arrow_map, read_table, slices
from closeledger.llm.words import shingle_hashes, shingle_strings, word_hashes

WIDTH = 5
#: Containment threshold in hundredths.
PERCENT = 80
#: Bytes of benchmark text in one broadcast block.
BLOCK = 16 << 20


def required(size: int, percent: int = PERCENT) -> int:
    """Fewest shared shingles that meet the threshold."""
    return -(-percent * size // 100)


def sketch_length(size: int, percent: int = PERCENT) -> int:
    """k of the item's size class: enough for every size in the class."""
    upper = (1 << size.bit_length()) - 1
    return min(size, upper - required(upper, percent) + 1)


@dataclass
class Index:
    """Sketches of one block of items, by shingle width."""

    ids: list
    sizes: list[int]
    shingles: list[set[bytes]]
    tables: dict[int, tuple[np.ndarray, np.ndarray]]  # width: sorted hashes, item numbers

    def find(self, text: str) -> list[tuple[int, int]]:
        """(item number, shared shingles) of the items that ``text`` contains."""
        candidates: dict[int, set[int]] = {}
        for width, (keys, items) in self.tables.items():
            found = shingle_hashes(text, width)
            if len(found) and len(keys):
                at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                for h in np.unique(found[keys[at] == found]):
                    low, high = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
                    candidates.setdefault(width, set()).update(items[low:high].tolist())
        out = []
        for width, numbers in candidates.items():
            own = shingle_strings(text, width)
            for i in sorted(numbers):
                shared = len(self.shingles[i] & own)
                if shared >= required(self.sizes[i]):
                    out.append((i, shared))
        return out


def build_index(rows: list[tuple[object, str]]) -> Index:
    index, entries = Index([], [], [], {}), {}
    for item_id, text in rows:
        n = len(word_hashes(text or ""))
        if not n:
            continue
        width = min(WIDTH, n)
        hashes = np.unique(shingle_hashes(text, width))
        keys, items = entries.setdefault(width, ([], []))
        sketch = hashes[: sketch_length(len(hashes))]
        keys.append(sketch)
        items.append(np.full(len(sketch), len(index.ids)))
        index.ids.append(item_id)
        index.shingles.append(shingle_strings(text, width))
        index.sizes.append(len(index.shingles[-1]))
    for width, (keys, items) in entries.items():
        k, i = np.concatenate(keys), np.concatenate(items)
        order = np.argsort(k, kind="stable")
        index.tables[width] = (k[order], i[order])
    return index


def blocks(benchmark: DataFrame, limit: int = BLOCK) -> Iterator[Index]:
    """The benchmark's items in blocks of about ``limit`` bytes."""
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    count = -(-total // limit)
    for b in range(count):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == b)
        yield build_index([(r["item_id"], r["text"]) for r in mine.collect()])


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, shared, item_shingles, containment: every document
    that contains at least 80 % of an item's shingles."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    doc_type, item_type = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = f"doc_id {doc_type.simpleString()}, item_id {item_type.simpleString()}, shared long, item_shingles long, containment double"
    out, item_arrow = spark.createDataFrame([], schema), to_arrow_type(item_type)
    for index in blocks(benchmark):
        shared_index = spark.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], shared_index=shared_index) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            index = shared_index.value
            for batch in slices(batches, "text"):
                rows, items, counts = [], [], []
                for row, text in enumerate(batch.column("text").to_pylist()):
                    for i, n in index.find(text or ""):
                        rows.append(row)
                        items.append(i)
                        counts.append(n)
                sizes = [index.sizes[i] for i in items]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(rows, pa.int64())),
                        pa.array([index.ids[i] for i in items], item_arrow),
                        pa.array(counts, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([n / s for n, s in zip(counts, sizes, strict=True)], pa.float64()),
                    ],
                    names=["doc_id", "item_id", "shared", "item_shingles", "containment"],
                )

        out = out.unionByName(arrow_map(rows, search, schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that contain a benchmark item."""
    out = docs
    for index in blocks(benchmark):
        shared_index = docs.sparkSession.sparkContext.broadcast(index)

        def keep(batches: Iterator[pa.RecordBatch], shared_index=shared_index) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            index = shared_index.value
            for batch in slices(batches, "text"):
                yield batch.filter(pa.array([not index.find(t or "") for t in batch.column("text").to_pylist()], pa.bool_()))

        out = arrow_map(out, keep, docs.schema)
    return out


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) pair with the item inside the document."""
    return matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean(docs, read_table(spark, sf_dir, "benchmark"))
