"""N-gram Jaccard join: documents whose sets of word shingles have a Jaccard
similarity of 0.8 or more, and the components that these links make.

Documents with equal sets are one class from the start.  Each class gives the
rarest shingles of its set to the join: with the shingles in one global order,
rare ones first, two linked sets of n shingles share one of their first
``n - ceil(0.8 n) + 1`` (prefix filter).  Rarity is the number of classes that hold
a shingle, counted exactly in one exchange (``entries``): a task packs the hashes of
many texts into a few rows of bytes, one per range of hashes, and the task of a
range counts in numpy.  Shingles of one class alone cannot link anything and end
there, and so does every class whose other shingles are under 80 % of its set.
Common shingles do not take part in the exchange: the sum of a hashed counter,
broadcast, bounds a shingle's classes from above, and where it is beyond one in
``COMMON`` of all classes (and well above the mean counter) it stands for their
number, so no task meets a shingle of more classes than that.  Ties go by hash.
Pairs that share a prefix shingle must pass the length
filter, the positional filter (what can still match before and after the shared
shingle) and the suffix filter (what can match in each of 16 hash ranges of the
sets), and are then verified once, on the whole sets of both texts.  Entries name
the entries just before them, so a pair that shares many is met at few of them.

A component does not need all its links.  Rounds of star pairs come first: in
each group of classes that share a prefix shingle, one class (by a hash that
changes with the round) is paired with those not yet in its component, each of
which is verified against its best partner.  Once few enough pairs are left
over (``work`` below), every pair whose ends are still in different components
is verified, so no link between two components is missed.  Groups of thousands
of near copies so cost a few rounds, not their square.

The links of every class are counted next (``link_counts``).  The ends of a link
are in one component, so every pair of classes of a component is compared once, on
the whole sets.  A component is split into blocks of bounded size by a hash of the
class, and each pair of blocks is one tile with the sets of both, so a hot component
is spread over many tasks.  A tile gives each class its number of linked rows, not
the links, so what it gives grows with its classes; ``linked`` gives the pairs.

Defined cases: a text without words, empty or null, has an empty set and links
with nothing (its own id is its component); fewer than five words make one
shingle; rows equal in id and text are members of one class; a null id is never
the smallest, and a component of null ids only has a null component id; an
empty table gives no rows; further columns are ignored, and kept by the stage.
Set identity rests on 64-bit hashes of 64-bit shingle hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from closeledger.llm.bits import among
from closeledger.llm.common import arrow_map, partitions, read_table, slices, stored, stored_with
from closeledger.llm.graph import components, roots_of, stars
from closeledger.llm.words import shingle_set

BUCKETS = 1 << 18
CLASSES = 16
#: Star rounds at most, and pairs per prefix entry that end them earlier.
ROUNDS, WORK = 8, 0.5
#: Earlier entries that an entry names.
NEAR = 8
#: Pairs of star steps between rounds.
STEPS = 2
#: Classes that a task remembers as already sent.
SEEN = 1 << 17
#: A shingle is common when its counter is beyond one in COMMON of all classes,
#: FAR times the mean counter, and FEW.
COMMON, FAR, FEW = 100, 4, 1000
#: Bytes of packed shingles that a counting task gets at most, about, bytes of a
#: pair of shingle and class among them, and bytes of text that are packed at once.
TASK_BYTES, PAIR_BYTES, PACK_BYTES = 16 << 20, 12, 4 << 20
#: Entries of an Arrow batch.
ENTRIES = 1 << 20
#: Shingles that a verifying task remembers.
HELD = 1 << 22
#: Shingles and classes that a block of a component has, about.
BLOCK_SHINGLES, BLOCK_CLASSES = 1 << 18, 256
#: Links that a task holds before it passes them on.
LINKS = 1 << 20


def prefix_length(n: int) -> int:
    return n - -(-4 * n // 5) + 1


def signature(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= 80 * (len(a) + len(b) - shared)


def _sets(batch: pa.RecordBatch, seen: set[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(class, shingle set) of texts whose class this task has not sent yet."""
    for text in batch.column("text").to_pylist():
        found = shingle_set(text or "")
        if len(found) and (sig := signature(found)) not in seen:
            if len(seen) >= SEEN:
                seen.clear()
            seen.add(sig)
            yield sig, found


def measured(docs: DataFrame) -> DataFrame:
    """One row per document (doc_id, place, n, class, parts), and one per
    counter that a task has used (bucket, n)."""
    rows = docs.select("doc_id", "text", place_of().alias("place"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, names = np.zeros(BUCKETS, np.int64), ["doc_id", "place", "n", "class", "parts", "bucket"]
        id_type, sent = None, set()
        for batch in slices(batches, "text"):
            sizes, classes, parts, buckets = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = shingle_set(text or "")
                sizes.append(len(found))
                classes.append(signature(found) if len(found) else None)
                parts.append(np.bincount((found >> np.uint64(60)).astype(np.int64), minlength=CLASSES).tolist())
                if len(found) and classes[-1] not in sent:
                    sent.add(classes[-1])
                    buckets.append((found & np.uint64(BUCKETS - 1)).astype(np.int64))
            if buckets:
                counts += np.bincount(np.concatenate(buckets), minlength=BUCKETS)
            if len(sent) > SEEN:
                sent.clear()
            id_type = batch.column("doc_id").type
            made = [pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), pa.array(parts, pa.list_(pa.int32())), pa.nulls(len(sizes), pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("place"), *made], names=names)
        used = np.flatnonzero(counts)
        if len(used):
            blank = [pa.nulls(len(used), t) for t in (id_type, pa.int64(), pa.int64(), pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([blank[0], blank[1], pa.array(counts[used]), blank[2], blank[3], pa.array(used)], names=names)

    kinds = [("place", LongType()), ("n", LongType()), ("class", LongType()), ("parts", ArrayType(IntegerType())), ("bucket", LongType())]
    return arrow_map(rows, measure, StructType([rows.schema["doc_id"], *[StructField(n, k) for n, k in kinds]]))


def place_of() -> Column:
    """Hash that leads from a class to a row with its text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.xxhash64(F.col("doc_id").cast("string"), text, F.octet_length(text))


_PACKED = ["part", "class", "own", "h", "count"]


def _packed(part: int, nodes: np.ndarray, own: np.ndarray | None, h: np.ndarray, count: np.ndarray | None) -> tuple:
    """A row of pairs: classes, for each pair the number of its class (none:
    one class a pair), shingles, and their counts."""
    blob = lambda x: b"" if x is None else x.tobytes()
    return part, blob(nodes), blob(own), blob(h), blob(count)


def _packed_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=_PACKED)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(class, shingle, count) arrays of packed rows; no counts where a row
    has none."""
    for batch in batches:
        for nodes, own, h, count in zip(*[batch.column(c) for c in _PACKED[1:]], strict=True):
            found = np.frombuffer(nodes.as_buffer(), np.int64)
            if len(own.as_buffer()):
                found = found[np.frombuffer(own.as_buffer(), np.uint16)]
            yield found, np.frombuffer(h.as_buffer(), np.uint64), np.frombuffer(count.as_buffer(), np.int64)


def _first(*keys: np.ndarray) -> np.ndarray:
    """Whether each row of sorted keys differs from the one before."""
    out = np.ones(len(keys[0]), bool)
    out[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return out


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal keys."""
    starts = np.flatnonzero(_first(*keys))
    return starts, np.diff(np.append(starts, len(keys[0])))


def _cuts(keys: np.ndarray, parts: int) -> Iterator[tuple[int, slice]]:
    """The slices of ascending 64-bit keys that lie in each of ``parts`` equal
    ranges (a power of two)."""
    width = np.uint64(64 - (parts.bit_length() - 1))
    at = keys >> width if parts > 1 else np.zeros(len(keys), np.uint64)
    for low, n in zip(*[x.tolist() for x in _runs(at)], strict=True):
        yield int(at[low]), slice(low, low + n)


def _parts_for(nbytes: int) -> int:
    """Ranges for so many packed bytes, one a task: a power of two."""
    return 1 << max(0, -(-nbytes // TASK_BYTES) - 1).bit_length()


def _scattered(texts: DataFrame, counts: np.ndarray, limit: float, parts: int) -> DataFrame:
    """Packed pairs of every class: by ranges of shingles without counts, and
    common shingles by ranges of classes with their counts."""
    order = texts.sparkSession.sparkContext.broadcast(counts)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text", PACK_BYTES):
            found = list(_sets(batch, seen))
            if not found:
                continue
            nodes, sizes = np.array([sig for sig, _ in found], np.int64), [len(x) for _, x in found]
            h = np.concatenate([x for _, x in found])
            found.clear()
            by = np.argsort(h, kind="stable").astype(np.int32)
            h, own = h[by], np.repeat(np.arange(len(nodes), dtype=np.uint16), sizes)[by]
            count = order.value[(h & np.uint64(BUCKETS - 1)).astype(np.int32)]
            rows = []
            for part, cut in _cuts(h, parts):
                rare = count[cut] <= limit
                mine, used = own[cut][rare], np.zeros(len(nodes), bool)
                used[mine] = True
                local = (np.cumsum(used, dtype=np.int32) - 1).astype(np.uint16)
                rows.append(_packed(part, nodes[used], local[mine], h[cut][rare], None))
            common = np.flatnonzero(count > limit)
            keys = nodes.view(np.uint64)[own[common]]
            common = common[np.argsort(keys, kind="stable")]
            for part, cut in _cuts(np.sort(keys), parts):
                mine = common[cut]
                rows.append(_packed(part, nodes[own[mine]], None, h[mine], count[mine]))
            yield _packed_rows(rows)

    return arrow_map(texts, scatter, "part int, class binary, own binary, h binary, count binary")


def _counted_pairs(packed: DataFrame, parts: int) -> DataFrame:
    """Pairs whose shingle two classes or more hold, packed by ranges of
    classes, with the number of those classes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, shingles = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for node, h, known in _unpacked(batches):
            if len(known):
                keys = node.view(np.uint64)
                yield _packed_rows([_packed(part, node[cut], None, h[cut], known[cut]) for part, cut in _cuts(keys, parts)])
            else:
                nodes.append(node)
                shingles.append(h)
        node, h = np.concatenate(nodes), np.concatenate(shingles)
        nodes.clear()
        shingles.clear()
        order = np.argsort(h, kind="stable")
        node, h = node[order], h[order]
        _, sizes = _runs(h)
        shared = np.repeat(sizes > 1, sizes)
        node, h = node[shared], h[shared]
        order = np.lexsort((node, h))  # a class that several tasks have sent counts once
        node, h = node[order], h[order]
        fresh = _first(h, node)
        node, h = node[fresh], h[fresh]
        _, sizes = _runs(h)
        n = np.repeat(sizes, sizes)
        node, h, n = node[n > 1], h[n > 1], n[n > 1]
        order = np.argsort(node.view(np.uint64), kind="stable")
        node, h, n = node[order], h[order], n[order]
        rows = [_packed(part, node[cut], None, h[cut], n[cut]) for part, cut in _cuts(node.view(np.uint64), parts)]
        if rows:
            yield _packed_rows(rows)

    return arrow_map(packed, count, packed.schema)


def _class_sizes(classes: DataFrame, parts: int) -> DataFrame:
    """Packed rows of all classes with their sizes and no shingles."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, n = (batch.column(c).to_numpy() for c in ("node", "n"))
            order = np.argsort(node.view(np.uint64), kind="stable")
            node, n = node[order], n[order].astype(np.int64)
            yield _packed_rows([_packed(part, node[cut], None, np.zeros(0, np.uint64), n[cut]) for part, cut in _cuts(node.view(np.uint64), parts)])

    return arrow_map(classes.select("node", "n"), pack, "part int, class binary, own binary, h binary, count binary")


def _prefixes(packed: DataFrame) -> DataFrame:
    """Prefix entries of the classes whose shared shingles reach 80 %."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sized, pairs = [], []
        for node, h, count in _unpacked(batches):
            (pairs if len(h) else sized).append((node, h, count))
        if not pairs:
            return
        known, n = np.concatenate([s[0] for s in sized]), np.concatenate([s[2] for s in sized])
        order = np.argsort(known)
        known, n = known[order], n[order]
        node, h, count = (np.concatenate([p[i] for p in pairs]) for i in range(3))
        order = np.lexsort((h, count, node))
        node, h = node[order], h[order]
        fresh = _first(node, h)
        node, h = node[fresh], h[fresh]
        starts, shared = _runs(node)
        n = n[np.searchsorted(known, node[starts])]
        before = np.arange(len(node)) - np.repeat(starts, shared)
        at, size = before + np.repeat(n - shared, shared), np.repeat(n, shared)
        kept = np.flatnonzero(np.repeat(5 * shared >= 4 * n, shared) & (at < size + (-4 * size // 5) + 1))
        for low in range(0, len(kept), ENTRIES):
            mine = kept[low : low + ENTRIES]
            columns = [h[mine].view(np.int64), node[mine], *[x[mine].astype(np.int32) for x in (size, at, before)]]
            back = mine[:, None] - np.arange(1, NEAR + 1)[None, :]
            named = np.arange(1, NEAR + 1)[None, :] <= before[mine][:, None]
            ends = np.concatenate([[0], np.cumsum(named.sum(axis=1))]).astype(np.int32)
            near = pa.ListArray.from_arrays(pa.array(ends), pa.array(h[back[named]].view(np.int64)))
            yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in columns], near], names=["h", "node", "n", "at", "before", "near"])

    return arrow_map(packed, cut, "h long, node long, n int, at int, before int, near array<long>")


def entries(docs: DataFrame, counts: np.ndarray, classes: DataFrame, total: int, kinds: int) -> DataFrame:
    """Prefix entries (h, node, n, at, before, near): ``at`` is a shingle's place
    in the order of its set, ``before`` the number of earlier ones that other
    classes hold, too, and ``near`` the last of those.  ``total`` shingles are in the sets of ``kinds`` classes."""
    limit = max(FAR * counts.sum() / BUCKETS, kinds / COMMON, FEW)
    parts = _parts_for(total * PAIR_BYTES)
    packed = _scattered(docs.select("text"), counts, limit, parts).repartitionById(parts, "part")
    pairs = stored(_counted_pairs(packed, parts), "pairs-of-shingles")
    return _prefixes(pairs.unionByName(_class_sizes(classes, parts)).repartitionById(parts, "part"))


def close(a: str, b: str) -> Column:
    """Length and positional filters of two entries.  What two sets share
    before a shared prefix shingle is in both prefixes, so it is an entry."""
    n, m, i, j = F.col(f"{a}_n"), F.col(f"{b}_n"), F.col(f"{a}_at"), F.col(f"{b}_at")
    most = F.least(F.col(f"{a}_before"), F.col(f"{b}_before")) + F.least(n - i, m - j)
    return (5 * F.least(n, m) >= 4 * F.greatest(n, m)) & (9 * most >= 4 * (n + m))


def counted(matches: DataFrame) -> DataFrame:
    """Pairs (a_node, b_node, shared) of matches that pass the filters."""
    return matches.where(close("a", "b")).groupBy("a_node", "b_node").agg(F.count("*").alias("shared"))


def suffix_filter(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) that could still share enough, by the parts of their sets;
    with the places of both texts."""
    side = lambda s: classes.select(F.col("node").alias(s), F.col("parts").alias(f"{s}_parts"), F.col("place").alias(f"{s}_place"), F.col("n").alias(f"{s}_n"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    most = F.aggregate(F.zip_with("a_parts", "b_parts", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    return both.where(9 * most >= 4 * (F.col("a_n") + F.col("b_n"))).select("a", "b", "a_place", "b_place")


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Linked pairs (u, v) among stored pairs (a, b, a_place, b_place)."""
    places = pairs.select(F.col("a_place").alias("place")).unionByName(pairs.select(F.col("b_place").alias("place")))
    texts = among(docs.select("text", place_of().alias("place")), places, "place")
    left = pairs.join(texts.select(F.col("place").alias("a_place"), F.col("text").alias("a_text")), "a_place")
    both = left.join(texts.select(F.col("place").alias("b_place"), F.col("text").alias("b_text")), "b_place")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        size = 0

        def set_of(node: int, text: str) -> np.ndarray | None:
            """The class's set, if the text is one of the class."""
            nonlocal size
            if node not in held:
                found = shingle_set(text)
                if signature(found) != node:
                    return None
                if size > HELD:
                    held.clear()
                    size = 0
                held[node] = found
                size += len(found)
            return held[node]

        for batch in slices(batches, "a_text"):
            keep = []
            columns = [batch.column(c).to_pylist() for c in ("a", "b", "a_text", "b_text")]
            for a, b, a_text, b_text in zip(*columns, strict=True):
                one, other = set_of(a, a_text), set_of(b, b_text)
                keep.append(one is not None and other is not None and _linked(one, other))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return arrow_map(both.select("a", "b", "a_text", "b_text"), verify, "u long, v long")


def links(docs: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """node, root of every class linked to a smaller one; ``found`` holds the
    prefix entries."""
    spark = docs.sparkSession
    edges = spark.createDataFrame([], "u long, v long")
    roots, grew, settled = None, False, False
    weights = found.groupBy("node").agg(F.count("*").alias("weight"))
    found, total = stored_with(found.join(weights, "node"), "weighted", n=F.count("*"))
    size = total["n"]
    for step in range(ROUNDS + 1):
        known = found.withColumn("root", F.col("node")) if roots is None else found.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        known = known.select("h", "node", "n", "at", "before", "root", "weight", "near")
        by = F.struct(F.lit(0) if step else -F.col("weight"), F.xxhash64("node", F.lit(step)))
        hub = F.min_by(F.struct("node", "n", "at", "before", "root"), by).alias("hub")
        groups = known.groupBy("h").agg(hub, F.count("*").alias("size"), F.min("root").alias("low"), F.max("root").alias("high"))
        groups = groups.where("low <> high").select("h", "size", *[F.col(f"hub.{c}").alias(f"b_{c}") for c in ("node", "n", "at", "before", "root")])
        open_ = known.select("h", *[F.col(c).alias(f"a_{c}") for c in ("node", "n", "at", "before", "root")])
        open_, total = stored_with(open_.join(groups, "h").where("a_root <> b_root"), "open", n=F.count("*"), work=F.sum("size"))
        if not total["n"]:
            break
        last = (step and (total["work"] <= WORK * size or not grew)) or step == ROUNDS
        if last:
            columns = ("node", "n", "at", "before", "root", "near")
            own, other = (known.select("h", *[F.col(c).alias(f"{side}_{c}") for c in columns]) for side in "ab")
            own = own.join(open_.select("h", "a_node"), ["h", "a_node"], "left_semi")
            # a pair that shares an entry named by both meets there, or at an earlier one
            pairs = counted(own.join(other, "h").where((F.col("a_root") != F.col("b_root")) & ~F.arrays_overlap("a_near", "b_near")))
            pairs = pairs.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()
        else:
            pairs = counted(open_).groupBy(F.col("a_node").alias("a")).agg(F.max_by("b_node", F.struct("shared", "b_node")).alias("b"))
        pairs, tried = stored_with(suffix_filter(pairs, classes), "pairs", n=F.count("*"))
        new, gained = stored_with(verified(pairs, docs), "links", n=F.count("*"))
        grew = 10 * gained["n"] >= tried["n"]
        # the next round needs no more than nodes known to be together; its
        # links join the stars that are there
        whole = last or step + 1 == ROUNDS
        if gained["n"] or (whole and not settled):
            edges = stars(edges.unionByName(new), None if whole else STEPS)
            roots, settled = stored(roots_of(edges), "roots"), whole
        if last:
            return roots
    if roots is None:
        return spark.createDataFrame([], "node long, root long")
    return roots if settled else components(edges)


def _shared(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of all sets in order, the number of the set of each, sizes."""
    sizes = np.array([len(s) for s in sets])
    shingles, owners = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(shingles, kind="stable")
    return shingles[order], owners[order], sizes


def _tile(left: dict[int, tuple], right: dict[int, tuple] | None) -> Iterator[tuple[int, np.ndarray]]:
    """(class of ``left``, places of its partners) between two blocks, or
    within one, where each pair comes once."""
    other = left if right is None else right
    if not left or not other:
        return
    shingles, owners, sizes = _shared([found for found, _ in other.values()])
    for at, (node, (found, _)) in enumerate(left.items()):
        low = np.searchsorted(shingles, found, "left")
        runs = np.searchsorted(shingles, found, "right") - low
        place = np.repeat(low - np.cumsum(runs) + runs, runs) + np.arange(runs.sum())
        shared = np.bincount(owners[place], minlength=len(sizes))
        hits = np.flatnonzero(100 * shared >= 80 * (len(found) + sizes - shared))
        hits = hits[hits > at] if right is None else hits
        if len(hits):
            yield node, hits


def _tile_links(left: dict[int, tuple], right: dict[int, tuple] | None) -> Iterator[pa.RecordBatch]:
    """Linked pairs (u, v) of a tile."""
    nodes, us, vs = np.array(list(left if right is None else right), np.int64), [], []
    for node, hits in _tile(left, right):
        us.append(np.full(len(hits), node))
        vs.append(nodes[hits])
        if sum(map(len, us)) > LINKS:
            yield _pairs(us, vs)
            us, vs = [], []
    if us:
        yield _pairs(us, vs)


def _pairs(us: list[np.ndarray], vs: list[np.ndarray]) -> pa.RecordBatch:
    u, v = np.concatenate(us), np.concatenate(vs)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])


def _tile_counts(left: dict[int, tuple], right: dict[int, tuple] | None) -> Iterator[pa.RecordBatch]:
    """(node, others): the rows that each class of a tile is linked to in it."""
    other = left if right is None else right
    rows = np.array([r for _, r in other.values()], np.int64)
    here, there = dict.fromkeys(left, 0), np.zeros(len(other), np.int64)
    for node, hits in _tile(left, right):
        here[node] += int(rows[hits].sum())
        there[hits] += left[node][1]
    nodes = np.array([*here, *other], np.int64)
    counts = np.concatenate([np.array(list(here.values()), np.int64), there])
    yield pa.RecordBatch.from_arrays([pa.array(nodes[counts > 0]), pa.array(counts[counts > 0])], names=["node", "others"])


def _tiles(docs: DataFrame, named: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``work`` of every tile of the components of ``named`` (node, root,
    place, n, rows); ``docs`` holds their texts."""
    sizes = named.groupBy("root").agg(F.count("*").alias("classes"), F.sum("n").alias("shingles")).where("classes > 1")
    blocks = F.ceil(F.greatest(F.col("shingles") / BLOCK_SHINGLES, F.col("classes") / BLOCK_CLASSES)).cast("long")
    parts = named.join(sizes.select("root", blocks.alias("blocks")), "root")
    parts = stored(parts.select("node", "root", "place", "rows", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block")), "blocks")
    texts = among(docs.select("text", place_of().alias("place")), parts, "place")
    own = ["root", "blocks", "block", "node", "rows"]

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [shingle_set(t or "") for t in batch.column("text").to_pylist()]
            # a place may be a stranger's
            right = pa.array([signature(f) == n for f, n in zip(found, batch.column("node").to_pylist(), strict=True)], pa.bool_())
            made = pa.array([f.tobytes() for f in found], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in own], made], names=[*own, "set"]).filter(right)

    kinds = "root long, blocks long, block long, node long, rows long, set binary"
    rows = stored(arrow_map(parts.join(texts, "place").select(*own, "text"), sets, kinds), "sets-of-blocks")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    key = ["root", "low", "high"]
    rows = rows.select("root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "rows", "set")
    rows = rows.repartition(partitions(docs.sparkSession), *key).sortWithinPartitions(*key)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tile = None, ({}, {})

        def done() -> Iterator[pa.RecordBatch]:
            if now is not None:
                yield from work(tile[0], None if now[1] == now[2] else tile[1])

        for batch in slices(batches, "set"):
            columns = [batch.column(c).to_pylist() for c in (*key, "block", "node", "rows", "set")]
            for root, low, high, block, node, n, found in zip(*columns, strict=True):
                if now != (root, low, high):
                    yield from done()
                    now, tile = (root, low, high), ({}, {})
                # rows equal in id and text come once each
                tile[block != low][node] = np.frombuffer(found, np.uint64), n
        yield from done()

    return arrow_map(rows, compare, schema)


def linked(docs: DataFrame, named: DataFrame) -> DataFrame:
    """Every linked pair (u, v), u < v, of the classes in ``named``."""
    return _tiles(docs, named, _tile_links, "u long, v long")


def link_counts(docs: DataFrame, named: DataFrame) -> DataFrame:
    """(node, others): the number of rows of other classes that a class is
    linked to, where there are any."""
    found = _tiles(docs, named, _tile_counts, "node long, others long")
    return found.groupBy("node").agg(F.sum("others").alias("others"))


def classed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, place, n, class) of all documents, and classes (node,
    place, n, rows, class_id, root, component_id)."""
    table = stored(measured(docs), "sets")
    counts = np.zeros(BUCKETS, np.int64)
    used = table.where("bucket is not null").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts[used["bucket"].to_numpy()] = used["n"].to_numpy()
    members = table.where("bucket is null").drop("bucket")
    classes = members.where("n > 0").groupBy(F.col("class").alias("node")).agg(
        F.min("place").alias("place"),
        F.first("n").alias("n"),
        F.first("parts").alias("parts"),
        F.count("*").alias("rows"),
        F.min("doc_id").alias("class_id"),
    )
    classes, seen = stored_with(classes, "classes", n=F.count("*"), shingles=F.sum("n"))
    found = entries(docs, counts, classes, seen["shingles"] or 0, seen["n"])
    roots = links(docs, classes, stored(found, "entries"))
    named = classes.drop("parts").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("class_id").alias("component_id"))
    return members.drop("parts"), named.join(smallest, "root")


def _of_documents(members: DataFrame, named: DataFrame, *more: str) -> DataFrame:
    out = members.join(named.select(F.col("node").alias("class"), "root", "class_id", "component_id", *more), "class", "left")
    own = lambda c: F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col(c)).alias(c)
    return out.select("doc_id", "place", "root", F.col("n").alias("n_shingles"), own("class_id"), own("component_id"), *more)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("string").alias("text"))


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, place, root, n_shingles, class_id, component_id of every row."""
    return _of_documents(*classed(_texts(docs)))


def joined(docs: DataFrame) -> DataFrame:
    """``grouped`` with n_links, the number of other rows that a row is linked
    to (those of its own class too)."""
    docs = _texts(docs)
    members, named = classed(docs)
    named = stored(named, "components")
    others = link_counts(docs, named.select("node", "root", "place", "n", "rows"))
    named = named.join(others, "node", "left").withColumn("n_links", F.coalesce("others", F.lit(0)) + F.col("rows") - 1)
    return _of_documents(members, named, "n_links").fillna(0, ["n_links"])


def linked_classes(docs: DataFrame) -> DataFrame:
    """Every linked pair (u, v) of classes with different sets."""
    docs = _texts(docs)
    _, named = classed(docs)
    return linked(docs, stored(named, "components").select("node", "root", "place", "n", "rows"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count, class, component and number of links of every whole
    document."""
    return joined(read_table(spark, sf_dir, "documents")).drop("place", "root")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: the smallest id, null ids last, then
    by a hash of the text; of rows equal in id and text, one.  Documents
    without words all stay."""
    found = stored(grouped(docs).where("n_shingles > 0").select("doc_id", "place", "root"), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "place")).getField("place").alias("kept")
    drop = found.join(found.groupBy("root").agg(first), "root").where("place <> kept").select(F.col("place").alias("_cl_place"))
    drop = stored(drop.distinct(), "dropped")
    same = stored(found.groupBy(F.col("place").alias("_cl_place")).agg(F.count("*").alias("n")).where("n > 1").drop("n"), "same")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    place = F.xxhash64(F.col("doc_id").cast("string"), text, F.octet_length(text))
    rest = docs.withColumn("_cl_place", place).join(drop, "_cl_place", "left_anti")
    if not same.isEmpty():
        once = rest.join(same, "_cl_place", "left_semi").dropDuplicates(["_cl_place"])
        rest = rest.join(same, "_cl_place", "left_anti").unionByName(once)
    return rest.drop("_cl_place")
