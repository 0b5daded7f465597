"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding follows the model's rule: every character is a symbol, and of all
adjacent pairs whose concatenation is a piece, the pair with the best score is
merged first, the leftmost of equal ones, until none is left.  Symbols that
are no piece fall back to byte pieces.

``merge_heap`` keeps that agenda as a heap, for one chunk of any length.
``merge_batch`` keeps the agendas of many short chunks at once as numpy arrays
and pops one pair of every chunk per round.  No piece has a space mark after
another character, so a text splits into chunks at space marks without change
of the result, and chunks already encoded are looked up.

In every Arrow batch the chunks seen for the first time are encoded by the
sentencepiece library too, and the ids of every whole text are decoded, here and
by the library; a difference raises an error.

Defined cases: a null text counts as empty (no ids, empty decoded text); a
null id is kept; repeated rows give repeated results; an empty table gives no
rows; further columns are ignored by the query and kept by the stage.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closeledger.llm.common import arrow_map, read_table, slices

SPACE = "▁"
#: Chunks of more symbols take the heap.
SHORT = 48
#: Bytes that a worker's memo of chunks keeps from one batch to the next, at most,
#: and bytes that an entry takes beside its ids and text, about.
MEMO_BYTES, ENTRY_BYTES = 24 << 20, 250
#: Symbols that one lockstep batch holds.
LOCKSTEP = 1 << 18
#: Bytes of text whose chunks a task holds at once; as a stage, in executors
#: that still hold the memory of the stages before, fewer.
BATCH, STAGE_BATCH = 2 << 20, 1 << 19


class Pieces:
    """Tables of one vocabulary, built from a serialized model."""

    def __init__(self, model: bytes) -> None:
        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        kinds = [(sp.is_control(i), sp.is_unknown(i), sp.is_byte(i), sp.is_unused(i)) for i in range(len(self.names))]
        if any(k[3] for k in kinds) or sp.normalize("Ａ  b ") != f"{SPACE}Ａ{SPACE}{SPACE}b{SPACE}":
            raise ValueError("only models with plain spaces and without unused pieces are supported")
        normal = [i for i, k in enumerate(kinds) if not any(k)]
        self.symbols = {self.names[i]: i for i in normal}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.symbols):
            raise ValueError("a piece has a space mark after another character")
        self.bytes = {self.names[i]: i for i, k in enumerate(kinds) if k[2]}
        self.byte_ids = [self.bytes[f"<0x{b:02X}>"] for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        #: Text of an id by itself, with spaces; bytes over 0x7F have none.
        self.plain = [n.replace(SPACE, " ") for n in self.names]
        for i, b in self.byte_of.items():
            self.plain[i] = chr(b) if b < 128 else None
        self.scores = np.array([sp.get_score(i) for i in range(len(self.names))])
        #: Characters that are part of a piece but no piece themselves get numbers above the ids.
        self.outside = dict(enumerate(sorted({c for p in self.symbols for c in p}.difference(self.symbols)), len(self.names)))
        self.symbols |= {c: n for n, c in self.outside.items()}
        self.of_point = np.full(0x110000, -1, np.int32)
        for c, n in self.symbols.items():
            if len(c) == 1:
                self.of_point[ord(c)] = n
        pairs = {}
        for i in normal:
            piece = self.names[i]
            for cut in range(1, len(piece)):
                left, right = self.symbols.get(piece[:cut]), self.symbols.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
        self.pairs = pairs
        #: The pairs as a hash table with linear probing, a slot four times as many.
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys, self.merged = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int32)
        left, value = np.fromiter(pairs.keys(), np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs))
        slot = self._slot(left)
        while len(left):
            free = np.flatnonzero(self.keys[slot] < 0)
            self.keys[slot[free]], taken = left[free], np.zeros(len(left), bool)
            taken[free] = self.keys[slot[free]] == left[free]  # of several in a slot one stays
            self.merged[slot[taken]] = value[taken]
            left, value, slot = left[~taken], value[~taken], slot[~taken] + 1 & len(self.keys) - 1
        #: Scores by order, equal ones alike, with room for a place below; the last, negative, for no piece.
        self.rank = (np.append(np.unique(self.scores, return_inverse=True)[1], -1) * 64).astype(np.int32)
        #: Ids of chunks, joined by commas and as 32-bit numbers.
        self.written = [str(i) for i in range(len(self.names))]
        self.digits = np.array([len(w) for w in self.written])
        self.memo: dict[str, tuple[str, bytes]] = {}
        self.held = 0

    @staticmethod
    def chunks(text: str) -> list[str]:
        """The normalised text cut before every space mark that follows
        another character, each chunk without its first space mark."""
        if not text:
            return []
        words = text.split(" ")
        if "" not in words and SPACE not in text:
            return words
        marked = SPACE + text.replace(" ", SPACE)
        return [c[1:] for c in re.findall(f"{SPACE}+[^{SPACE}]*", marked)]

    def numbers(self, chunk: str) -> np.ndarray:
        """Symbols of the characters; unknown characters are negative."""
        points = np.frombuffer(chunk.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        known = self.of_point[points]
        return np.where(known < 0, -1 - points, known)

    def ids(self, symbols: list[int]) -> list[int]:
        """Piece ids of merged symbols, bytes for symbols that are no piece."""
        out = []
        for s in symbols:
            if 0 <= s < len(self.names):
                out.append(s)
            else:
                c = chr(-1 - s) if s < 0 else self.outside[s]
                out += [self.byte_ids[b] for b in c.encode("utf-8")]
        return out

    def merge_heap(self, chunk: str) -> list[int]:
        """Score-ordered agenda of one chunk."""
        symbols: list[int | None] = self.numbers(chunk).tolist()
        left, right = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
        agenda: list[tuple[float, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0:
                a, b = symbols[i], symbols[j]
                if a >= 0 and b >= 0 and (m := self.pairs.get(a << 32 | b)) is not None:
                    heapq.heappush(agenda, (-self.scores[m], i, a, b, m))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while agenda:
            _, i, a, b, m = heapq.heappop(agenda)
            j = right[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue
            symbols[i], symbols[j], right[i] = m, None, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [s for s in symbols if s is not None]

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merged piece of each pair, -1 where there is none."""
        shape, none = a.shape, (a < 0) | (b < 0)
        key = (a.astype(np.int64) << 32 | b).ravel()
        key[none.ravel()] = 0  # no pair: both would be id 0
        slot = self._slot(key)
        held, out = self.keys[slot], self.merged[slot]
        left = np.flatnonzero(held != key)
        out[left] = -1
        left = left[held[left] >= 0]
        at = slot[left]
        while len(left):
            at = at + 1 & len(self.keys) - 1
            held = self.keys[at]
            same = held == key[left]
            out[left[same]] = self.merged[at[same]]
            on = ~same & (held >= 0)
            left, at = left[on], at[on]
        return out.reshape(shape)

    def merge_batch(self, chunks: list[str]) -> list[list[int]]:
        """The agendas of many short chunks in lockstep: the best pair of every
        chunk is merged in each round."""
        flat, lengths = self.merge_flat(chunks)
        flat, ends = flat.tolist(), np.cumsum(lengths).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def merge_flat(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all chunks, one after the other, and their numbers."""
        widths, done = np.array([len(c) for c in chunks], np.int64), []
        for width in np.unique(widths[widths > 0]).tolist():
            own = np.flatnonzero(widths == width)
            for part in np.array_split(own, len(own) * width // LOCKSTEP + 1):
                symbols = self.numbers("".join([chunks[i] for i in part.tolist()])).astype(np.int32)
                done += self._lockstep(part, np.ascontiguousarray(symbols.reshape(len(part), width).T))
        lengths = np.zeros(len(chunks), np.int64)
        for number, symbols in done:
            lengths[number] = len(symbols)
        starts = np.cumsum(lengths) - lengths
        flat = np.empty(int(lengths.sum()), np.int64)
        for number, symbols in done:
            flat[starts[number] + np.arange(len(symbols))[:, None]] = symbols
        return flat, lengths

    def _lockstep(self, number: np.ndarray, symbols: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(numbers of chunks, their symbols, a column a chunk) as they end."""
        done, place = [], np.arange(SHORT + 1, dtype=np.int32)[:, None]
        pairs = self._lookup(symbols[:-1], symbols[1:])
        ranks = self.rank[pairs]
        while len(pairs):
            # rank, then the place counted from the right: the leftmost of the best
            best = (ranks + (63 - place[: len(pairs)])).max(axis=0)
            live = best >= 0
            if not live.all():
                done.append((number[~live], symbols[:, ~live]))
                number, symbols, pairs, ranks, best = number[live], symbols[:, live], pairs[:, live], ranks[:, live], best[live]
                if not len(number):
                    return done
            at, rows, width = 63 - (best & 63), np.arange(len(number)), len(symbols)
            symbols[at, rows] = pairs[at, rows]
            symbols = np.where(place[: width - 1] <= at, symbols[:-1], symbols[1:])
            before = place[: width - 2] < at
            pairs, ranks = np.where(before, pairs[:-1], pairs[1:]), np.where(before, ranks[:-1], ranks[1:])  # without the pair that was merged
            for where, ok in ((at - 1, at > 0), (at, at < width - 2)):
                r, p = rows[ok], where[ok]
                pairs[p, r] = made = self._lookup(symbols[p, r], symbols[p + 1, r])
                ranks[p, r] = self.rank[made]
        done.append((number, symbols))
        return done

    def decode(self, ids: list[int]) -> str:
        """Text of piece ids; runs of byte pieces are read as UTF-8, and the
        space before the first piece is dropped."""
        out, held = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held = bytearray()
            out.append(self.names[i])
        if held:
            out.append(held.decode("utf-8", "replace"))
        return "".join(out).replace(SPACE, " ").removeprefix(" ")

    def text_of(self, ids: list[int]) -> str:
        """``decode``, at once where no id is part of a character."""
        try:
            return "".join(map(self.plain.__getitem__, ids)).removeprefix(" ")
        except TypeError:  # None
            return self.decode(ids)

    def learn(self, chunks: list[str]) -> dict[str, tuple[str, bytes]]:
        """Memo entries of new chunks.  Their ids must equal the library's."""
        size, long = len(self.names), [c for c in chunks if len(c) >= SHORT]
        new = [c for c in chunks if len(c) < SHORT]
        flat, lengths = self.merge_flat([SPACE + c for c in new])
        found = [self.ids(self.merge_heap(SPACE + c)) for c in long]
        ascii_ = (flat < 0) & (flat >= -128)  # a byte each
        flat[ascii_] = np.array(self.byte_ids)[-1 - flat[ascii_]]
        outside = np.flatnonzero((flat < 0) | (flat >= size))
        if len(outside):  # several bytes each: as lists, after the others
            ends = np.cumsum(lengths)
            other = np.unique(np.searchsorted(ends, outside, "right")).tolist()
            kept = np.ones(len(new), bool)
            kept[other] = False
            long += [new[i] for i in other]
            found += [self.ids(flat[ends[i] - lengths[i] : ends[i]].tolist()) for i in other]
            flat, lengths, new = flat[np.repeat(kept, lengths)], lengths[kept], [new[i] for i in np.flatnonzero(kept).tolist()]
        new += long
        flat = np.append(flat, np.fromiter(chain.from_iterable(found), np.int64))
        ends = np.cumsum(np.append(lengths, [len(f) for f in found])).astype(np.int64)
        expected = self.library.encode([c.replace(SPACE, " ") for c in new], num_threads=1)
        if "" in chunks:  # a last space; as a text of its own it would be empty
            expected[new.index("")] = [self.library.piece_to_id(SPACE)]
        listed, wanted = flat.tolist(), list(chain.from_iterable(expected))
        if listed != wanted or ends.tolist() != list(accumulate(map(len, expected))):
            pairs = zip(new, np.split(flat, ends[:-1]), expected, strict=True)
            c, ids, want = next(x for x in pairs if x[1].tolist() != x[2])
            raise ValueError(f"encoding differs from the library: {c!r}: {ids.tolist()}, not {want}")
        joined = ",".join(map(self.written.__getitem__, listed))
        stops = np.cumsum(self.digits[flat] + 1)[ends - 1].tolist()
        data, joined_at, data_at = flat.astype(np.int32).tobytes(), [0, *stops], [0, *(4 * ends).tolist()]
        parts = zip(zip(joined_at, stops, strict=False), zip(data_at, data_at[1:], strict=False), strict=True)
        return {c: (joined[i : j - 1], data[k:n]) for c, ((i, j), (k, n)) in zip(new, parts, strict=True)}

    def keep(self, entries: dict[str, tuple[str, bytes]], times: Counter[str], split: list[list[str]]) -> None:
        """Add a batch's new chunks to the memo: those that came again, and while
        it is not half full those that came once; no long ones, which hardly come
        again.  When it is full, the oldest of those that the batch did not use go."""
        short = [(c, n) for c, n in times.items() if len(c) < SHORT]
        again, once = [c for c, n in short if n > 1], [c for c, n in short if n == 1]
        for i, c in enumerate(chain(again, once)):
            if i >= len(again) and self.held > MEMO_BYTES // 2:
                break
            self.memo[c] = a, b = entries[c]
            self.held += ENTRY_BYTES + len(c) + len(a) + len(b)
        if self.held > MEMO_BYTES:
            used = set(chain.from_iterable(split))
            self.forget([c for c in self.memo if c not in used])
        if self.held > MEMO_BYTES:
            self.forget(list(self.memo))

    def forget(self, chunks: list[str]) -> None:
        """Drop the first of these until a quarter of the memo's bytes is free."""
        for c in chunks:
            if self.held <= MEMO_BYTES * 3 // 4:
                break
            a, b = self.memo.pop(c)
            self.held -= ENTRY_BYTES + len(c) + len(a) + len(b)

    def looked_up(self, split: list[list[str]]) -> list[tuple[str, np.ndarray]]:
        """Ids of texts in chunks, joined by commas and as numbers."""
        gc.disable()  # a batch makes many lists, none in a cycle
        try:
            parts = [list(map(self.memo.get, own)) for own in split]
            times = Counter([c for own, got in zip(split, parts, strict=True) for c, part in zip(own, got, strict=True) if part is None])
            entries, found = self.learn(list(times)) if times else {}, []
            for own, got in zip(split, parts, strict=True):
                got = [part or entries[c] for c, part in zip(own, got, strict=True)]
                found.append((",".join([p[0] for p in got]), np.frombuffer(b"".join([p[1] for p in got]), np.int32)))
            self.keep(entries, times, split)
        finally:
            gc.enable()
        return found

    def encode(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """(number of ids, ids joined by commas, decoded text) of every text."""
        found = self.looked_up([self.chunks(t) for t in texts])
        texts_of_library = self.library.decode([ids for _, ids in found], num_threads=1) if found else []
        for (joined, ids), expected in zip(found, texts_of_library, strict=True):
            ids = ids.tolist()
            text = self.text_of(ids)
            if text != expected:
                raise ValueError(f"decoding differs from the library: {ids}")
            yield len(ids), joined, text


_loaded: dict[bytes, Pieces] = {}


def loaded(model: bytes) -> Pieces:
    """The worker's own tables of a model, built once per process."""
    key = hashlib.sha256(model).digest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Pieces(model)
    return _loaded[key]


def model_bytes(path: str | None = None) -> bytes:
    """The vocabulary file, read on the driver; the default is the public
    32k model."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def encoded(docs: DataFrame, columns: list[str], path: str | None = None, size: int = BATCH, keep: bool = True) -> DataFrame:
    """``columns`` of docs with n_tokens, ids_sha256 and decoded_sha256.  A
    column of one of these names gives way to the new one.  Unless ``keep``, a
    task's end drops the worker's tables and memo."""
    made = ["n_tokens", "ids_sha256", "decoded_sha256"]
    model = docs.sparkSession.sparkContext.broadcast(model_bytes(path))
    rows = docs.select(*[c for c in columns if c not in made], F.col("text").cast("string").alias("_cl_text"))
    kept = [f for f in rows.schema.fields if f.name != "_cl_text"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(model.value)
        for batch in slices(batches, "_cl_text", size):
            counts, ids, decoded = [], [], []
            for n, joined, text in pieces.encode([t or "" for t in batch.column("_cl_text").to_pylist()]):
                counts.append(n)
                ids.append(digest(joined))
                decoded.append(digest(text))
            columns = [batch.column(f.name) for f in kept]
            columns += [pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*(f.name for f in kept), *made])
        if not keep:
            _loaded.clear()

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
    return arrow_map(rows, encode, ", ".join([*types, "n_tokens long", "ids_sha256 string", "decoded_sha256 string"]))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document."""
    return encoded(read_table(spark, sf_dir, "documents"), ["doc_id"])


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token counts and digests."""
    # idle workers live on, so what they hold adds up in later stages and runs
    return encoded(docs, docs.columns, size=STAGE_BATCH, keep=False)
