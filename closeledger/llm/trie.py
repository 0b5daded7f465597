"""Prefix trie of sequences by the van Emde Boas recursion, for conversations.

A trie whose height is a power of two is cut at half its depth: the upper half
is one trie, and under every cut prefix hangs a lower one.  All tries of one
height are cut in the same Spark pass, so the number of passes grows with the
logarithm of the longest sequence, and no sequence is ever gathered in a task.

1. Names going up: a block of 2**(k+1) turns is named by the names of its two
   halves (``_blocks``).
2. Prefixes going down: a trie is known by the name of the prefix above it; the
   cut prefix of its lower tries is that name with the name of the upper half's
   block (``_paths``).  After the last cut every place of every sequence has the
   name of its prefix, which is its node.
3. Totals going up: the tries of one height hold their totals; where an upper
   and its lower tries are put together, the totals of a lower trie are grafted
   onto its cut node and from there onto that node's ancestors in the upper trie,
   which are the places of the path of its smallest member (``_totals``).

Names are pairs of 64-bit hashes.  A node's smallest member and its depth tell
it apart from every other node.  A digest over the members that end in a node is
taken from chunks of ids that are joined where the sorted ids lie, and streams
through one hash, so a node with a third of all members costs a few rows.

Defined cases of the conversation query: rows without a conversation id belong
to none; ties of turn go by role, the first 64 characters of the text, then a
hash of it; a null role or text is the empty one; repeated rows are turns of
their own; ``c % 20`` has the sign of c, as in SQL; a conversation that is
rebuilt without turns is a member of the root; an empty table has no node, not
even a root; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closeledger.llm.common import arrow_map, partitions, ranked, read_table, stored, stored_with

#: log2 of the places of a path that one row of grafted totals meets in the join.
SPAN = 10
#: Bytes of joined ids in one row.
CHUNK_BYTES = 1 << 20

ID = ["hi", "lo"]
WORD = r"[^\x20\x09-\x0D]+"


def _name(*parts: Column) -> list[Column]:
    return [F.xxhash64(F.lit(i), *parts).alias(c) for i, c in enumerate(ID, 1)]


def _blocks(sequences: DataFrame, levels: int) -> list[DataFrame]:
    """Names of the whole blocks of 2**k places, for k below ``levels``:
    (seq, block, hi, lo)."""
    out = [sequences.select("seq", F.col("pos").alias("block"), *ID)]
    for k in range(1, levels):
        half = [F.max(F.when(F.col("block") % 2 == side, F.col(c))).alias(f"{c}{side}") for side in (0, 1) for c in ID]
        pairs = out[-1].groupBy("seq", F.shiftright("block", 1).alias("block")).agg(F.count("*").alias("n"), *half)
        named = pairs.where("n = 2").select("seq", "block", *_name(*[F.col(f"{c}{side}") for side in (0, 1) for c in ID]))
        out.append(stored(named, f"blocks{k}"))
    return out


def _paths(sequences: DataFrame, lengths: DataFrame, levels: int) -> DataFrame:
    """The node of every prefix of every sequence: (seq, depth, hi, lo, length,
    weight); weight is that of the prefix's last place, null at the root."""
    blocks = _blocks(sequences, levels)
    now = lengths.select("seq", F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(c) for c in ID], "length")
    for k in range(levels - 1, -1, -1):
        upper = blocks[k].where("block % 2 = 0")
        upper = upper.select("seq", F.shiftleft("block", k).alias("depth"), *[F.col(c).alias(f"b_{c}") for c in ID])
        names = _name(*[F.col(c) for c in ID], *[F.col(f"b_{c}") for c in ID])
        cut = now.join(upper, ["seq", "depth"]).select("seq", (F.col("depth") + (1 << k)).alias("depth"), *names, "length")
        now = now.unionByName(cut)
        now = stored(now, f"prefixes{k}") if k else now
    weights = sequences.select("seq", (F.col("pos") + 1).alias("depth"), "weight")
    return stored(now.join(weights, ["seq", "depth"], "left"), "paths")


def _nodes(paths: DataFrame) -> DataFrame:
    """One row per node: id, owner (smallest member), depth, members, weight,
    the parent's id and owner, children."""
    nodes = paths.groupBy(*ID).agg(
        F.min("seq").alias("owner"), F.max("depth").alias("depth"), F.count("*").alias("members"), F.max("weight").alias("weight")
    )
    above = paths.select(F.col("seq").alias("owner"), (F.col("depth") + 1).alias("depth"), *[F.col(c).alias(f"p_{c}") for c in ID])
    nodes = stored(nodes.join(above, ["owner", "depth"], "left"), "nodes")
    parent = nodes.select(*[F.col(c).alias(f"p_{c}") for c in ID], F.col("owner").alias("p_owner"))
    children = nodes.where("depth > 0").groupBy("p_hi", "p_lo").agg(F.count("*").alias("children"))
    children = children.select(F.col("p_hi").alias("hi"), F.col("p_lo").alias("lo"), "children")
    out = nodes.join(parent, ["p_hi", "p_lo"], "left").join(children, ID, "left")
    return stored(out.withColumn("children", F.coalesce("children", F.lit(0).cast("long"))), "family")


def _totals(nodes: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """(hi, lo, leaves, saved) of the whole subtree of every node."""
    weight = F.coalesce("weight", F.lit(0).cast("long"))
    still = ["depth", "p_hi", "p_lo", "p_owner"]
    own = [(F.col("children") == 0).cast("long").alias("leaves"), ((F.col("members") - 1) * weight).alias("saved")]
    now = nodes.select(*ID, *still, *own)
    sums = [F.sum(c).alias(c) for c in ("leaves", "saved")]
    for k in range(levels):
        above = F.col("depth") - 1  # depth of the cut node
        lower = now.where((F.col("depth") > 0) & (above % (1 << k) == 0) & (F.shiftright(above, k) % 2 == 1))
        gains = lower.groupBy("p_hi", "p_lo").agg(F.max("p_owner").alias("seq"), F.max(above).alias("cut"), *sums)
        span = min(k, SPAN)
        runs = F.sequence(F.shiftright(F.col("cut") - (1 << k), span), F.shiftright(F.col("cut") - 1, span))
        gains = gains.select("seq", F.explode(runs).alias("run"), "leaves", "saved")
        places = paths.where("depth > 0").select("seq", F.shiftright(F.col("depth") - 1, span).alias("run"), *ID)
        grafted = places.join(gains, ["seq", "run"]).select(*ID, "leaves", "saved")
        both = now.unionByName(grafted, allowMissingColumns=True)
        now = stored(both.groupBy(*ID).agg(*[F.max(c).alias(c) for c in still], *sums), f"grafted{k}")
    root = now.where("depth = 1").agg(*sums).select(*[F.lit(0).cast("long").alias(c) for c in ID], "leaves", "saved")
    whole = now.select(*ID, "leaves", "saved").unionByName(root.where("leaves is not null"))
    return whole.groupBy(*ID).agg(*sums)


def _digests(ends: DataFrame) -> DataFrame:
    """(hi, lo, sha256) over the ascending decimal ``seq`` of each node,
    comma-joined."""
    order = [*ID, "seq"]
    rows = ends.select(*order).repartitionByRange(partitions(ends.sparkSession), *order).sortWithinPartitions(*order)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids, held = None, None, [], 0
        for batch in batches:
            done = []
            for hi, lo, seq in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if ids and (node != (hi, lo) or held > CHUNK_BYTES):
                    done.append((*node, first, ",".join(ids)))
                    ids, held = [], 0
                if not ids:
                    node, first = (hi, lo), seq
                ids.append(str(seq))
                held += len(ids[-1]) + 1
            yield _rows(done, *ID, "first", "ids")
        if ids:
            yield _rows([(*node, first, ",".join(ids))], *ID, "first", "ids")

    chunks = stored(arrow_map(rows, joined, "hi long, lo long, first long, ids string"), "chunks")
    chunks = chunks.repartition(partitions(ends.sparkSession), *ID).sortWithinPartitions(*ID, "first")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, seen = None, None
        for batch in batches:
            done = []
            for hi, lo, ids in zip(*[batch.column(c).to_pylist() for c in (*ID, "ids")], strict=True):
                if node == (hi, lo):
                    seen.update(b",")
                else:
                    if node is not None:
                        done.append((*node, seen.hexdigest()))
                    node, seen = (hi, lo), hashlib.sha256()
                seen.update(ids.encode())
            yield _rows(done, *ID, "sha256")
        if node is not None:
            yield _rows([(*node, seen.hexdigest())], *ID, "sha256")

    return arrow_map(chunks, digest, "hi long, lo long, sha256 string")


def _rows(rows: list[tuple], *names: str) -> pa.RecordBatch:
    """Rows of longs whose last column is text."""
    kinds = [pa.int64()] * (len(names) - 1) + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=list(names))


def prefix_trie(sequences: DataFrame, lengths: DataFrame) -> DataFrame:
    """The trie of all prefixes of ``sequences`` (seq, pos from 0 without gaps,
    hi, lo: the place's name, weight) with ``lengths`` (seq, length) of all of
    them, empty ones included.

    One row per node: seq (smallest member), depth, parent_seq, members,
    children, leaves, saved (over the subtree: (members - 1) * weight of a
    node's last place), ends_sha256 (digest of the members that end there)."""
    top = lengths.agg(F.max("length").alias("top")).first()["top"]
    levels = (int(top) - 1).bit_length() if top else 0
    levels = levels + 1 if top == 1 << levels else levels  # a whole sequence's prefix is a cut, too
    paths = _paths(sequences, lengths, levels)
    nodes = _nodes(paths)
    found = nodes.join(_totals(nodes, paths, levels), ID).join(_digests(paths.where("depth = length")), ID, "left")
    return found.select(
        F.col("owner").alias("seq"),
        "depth",
        F.col("p_owner").alias("parent_seq"),
        "members",
        "children",
        "leaves",
        "saved",
        F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def rebuilt(conversations: DataFrame, group: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Sequences and lengths of the rebuilt conversations: the first h turns of
    the conversation c - c % ``group``, then the own turns after the first h,
    with h = crc32(c) % ``heads``."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("seq"),
        "turn",
        role.alias("role"),
        F.substring(text, 1, 64).alias("head"),
        *_name(role, text),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("weight"),
    )
    turns, _ = ranked(turns, ["seq", "turn", "role", "head", *ID], "rank", "turns")
    turns = turns.select("seq", "rank", *ID, "weight")
    shared = F.crc32(F.col("seq").cast("string").cast("binary")) % heads
    whole = turns.groupBy("seq").agg(F.min("rank").alias("start"), F.count("*").alias("n"))
    whole = whole.select("seq", "start", "n", shared.alias("h"), (F.col("seq") - F.col("seq") % group).alias("base"))
    lead = F.least("h", F.coalesce("base_n", F.lit(0).cast("long")))
    own = F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long"))
    whole = stored(whole, "conversations")
    whole = whole.join(whole.select(F.col("seq").alias("base"), F.col("n").alias("base_n")), "base", "left")
    whole = stored(whole.select("seq", "start", "base", "h", lead.alias("lead"), (lead + own).alias("length")), "rebuilt")
    placed = turns.join(whole, "seq").withColumn("at", F.col("rank") - F.col("start"))
    kept = placed.where("at >= h").select("seq", (F.col("lead") + F.col("at") - F.col("h")).alias("pos"), *ID, "weight")
    first = placed.where((F.col("at") < heads - 1) & (F.col("seq") == F.col("base")))
    first = first.select("base", F.col("at").alias("pos"), *ID, "weight")
    lent = whole.select("seq", "base", "lead").join(first, "base").where("pos < lead").select("seq", "pos", *ID, "weight")
    sequences, _ = stored_with(kept.unionByName(lent), "sequences", n=F.count("*"))
    return sequences, whole.select("seq", "length")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    trie = prefix_trie(*rebuilt(read_table(spark, sf_dir, "conversations")))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return trie.toDF(*names)


#: CRC-32 of the decimal conv_id, from the reflected polynomial 0xEDB88320.
_CRC = """xor(list_reduce(
        list_concat([4294967295::UBIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::UBIGINT)),
        lambda r, b: list_reduce(list_concat([xor(r, b)], list_resize([]::UBIGINT[], 8, 0::UBIGINT)),
            lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)), 4294967295::UBIGINT)"""


def oracle_sql() -> str:
    """The same rows by whole prefixes and all their ancestors."""
    return f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS spot
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC} % 4 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
places AS (
  SELECT c.conv_id, 0 AS part, t.spot, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.spot < c.h
  UNION ALL
  SELECT c.conv_id, 1, t.spot, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.spot >= c.h),
sequences AS (
  SELECT c.conv_id, coalesce(list([p.role, p.text] ORDER BY part, spot) FILTER (WHERE p.role IS NOT NULL), []::VARCHAR[][]) AS turns
  FROM convs c LEFT JOIN places p USING (conv_id) GROUP BY c.conv_id),
paths AS (
  SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM sequences),
nodes AS (
  SELECT turns[1:depth] AS key, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = len(turns)), '')) AS ends_sha256
  FROM paths GROUP BY ALL),
family AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
         CASE WHEN n.depth = 0 THEN 0 ELSE len(regexp_extract_all(n.key[n.depth][2], '[^\\x20\\x09-\\x0D]+')) END AS words,
         (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.key[1:n.depth] = n.key) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.key = n.key[1:n.depth - 1]),
subtrees AS (
  SELECT key[1:above] AS key, above AS depth, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS above FROM family) GROUP BY ALL)
SELECT f.conv_id, f.depth, f.parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved::BIGINT AS saved_tokens, f.ends_sha256
FROM family f JOIN subtrees s ON s.depth = f.depth AND s.key = f.key
"""
