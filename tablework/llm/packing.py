"""Packing: a sharded BM25 inverted index gives each seed document unused neighbours that fill its window.

1. One pass tokenises every text and stores the ids; each task adds the document frequencies of its ids, so that idf and mean
   length are those of the whole corpus. Texts are not read again.
2. A document's shard is a minhash of its subject: of its ``SKETCH_TERMS`` heaviest terms by BM25 weight that a second document
   has, the one of smallest hash. Documents that share heavy terms are so likely to share a shard. The documents of a term that
   a task sees are dealt on to a further shard of that term whenever they have filled their part of a block, so a term that a third of
   all documents has still fills blocks evenly.
3. A task reads its shards in order, a bounded number of tokens at a time (a block), and builds an inverted index over the block:
   postings sorted by term, each with its BM25 weight. A seed's query is its ``query_terms`` terms of largest
   weight; the best unused neighbours follow it into the window. What no longer fits is cut there and
   starts the next window, for which that document is the seed. A window that is open when a block ends
   goes on with the next block. The last window of a task is cut into sequences whose lengths are
   powers of two, so nothing is padded.

A seed searches its block. What it can find there of its true neighbours is measured in the tests and stated in the README.

Bounded memory: one block and its index, and a number for each id of the vocabulary. No row depends on another task, so a lost
executor costs its tasks only; shards follow from the stored ids and the order in which they lie there, so reruns over the same files agree.

A null text is empty: the document is its end id alone. Repeated rows and copies are packed each for
itself; a null id stays null. An empty table gives no pieces.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.llm import common

WINDOW = 2048
BLOCK_TOKENS = 2_000_000
QUERY_TERMS = 32
NEIGHBOURS = 16
SKETCH_TERMS = 64
K1, B = 1.2, 0.75
END_ID = 1
_ROWS = 512  # pieces of an output batch, at most 4 MB of ids
MERGES = "byte_bpe_50k"
_SPECIAL = "<|endoftext|>"
#: Letters and marks below these code points are old enough that both tokenizer libraries class them alike.
_LATER = re.compile("[\u0530-\U0010ffff]")
_PIECE = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
          ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]


def encoder(json_path: str, ranks_path: str | None):
    """Text to ids (numpy), as the tokenizer file gives them without special tokens added.

    The same vocabulary as merge ranks is read by a faster library; texts with letters beyond the
    early scripts, where the libraries may class characters differently, go to the file itself.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    @functools.cache
    def file() -> Tokenizer:  # read at the first text that needs it
        return Tokenizer.from_file(json_path)

    def slow(text: str) -> np.ndarray:
        return np.array(file().encode(text, add_special_tokens=False).ids, np.uint32)

    if ranks_path is None:
        return slow
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint32)
        if _SPECIAL in text or not text.isascii() and _LATER.search(text):
            return slow(text)
        return fast.encode_to_numpy(text, disallowed_special=())

    return encode


class Weights:
    """BM25 weights by the statistics of the corpus: its size, mean length and document frequencies."""

    def __init__(self, n: int, length: float, df: np.ndarray):
        self.df, self.length = df, max(1.0, length)
        self.idf = np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32)

    def of(self, terms: np.ndarray, tf: np.ndarray, length) -> np.ndarray:
        return self.idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / self.length))

    def sketch(self, ids: np.ndarray) -> int:
        """The term of smallest hash among the ``SKETCH_TERMS`` heaviest that a second document has; -1 without any."""
        terms, tf = distinct(ids)
        shared = self.df[terms] > 1
        terms, tf = terms[shared], tf[shared]
        if len(terms) > SKETCH_TERMS:
            weight = self.of(terms, tf.astype(np.float32), len(ids))
            terms = terms[np.argpartition(-weight, SKETCH_TERMS)[:SKETCH_TERMS]]
        return int(terms[common.mix(terms.astype(np.uint64)).argmin()]) if len(terms) else -1


def distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct ids and their counts; ids of 16 bits are sorted by radix."""
    own = np.sort(ids, kind="stable")
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    return own[first], np.diff(np.r_[first, len(own)])


def read_ids(raw, wide: bool) -> np.ndarray:
    return np.frombuffer(raw, np.uint32 if wide else np.uint16)


class Index:
    """BM25 postings of one block, by term."""

    def __init__(self, ids: list[np.ndarray], query_terms: int, corpus: Weights):
        self.n, self.query_terms = len(ids), query_terms
        terms, counts, sizes = [], [], np.empty(self.n, np.int64)
        for i, own in enumerate(ids):
            term, tf = distinct(own)
            terms.append(term)
            counts.append(tf)
            sizes[i] = len(term)
        self.at = np.r_[0, np.cumsum(sizes)]
        self.terms = np.concatenate(terms)
        tf = np.concatenate(counts).astype(np.float32)
        length = np.array([len(x) for x in ids], np.float32)
        vocabulary = int(self.terms.max()) + 1
        df = np.bincount(self.terms, minlength=vocabulary)
        self.weight = corpus.of(self.terms, tf, np.repeat(length, sizes)).astype(np.float32)
        order = np.argsort(self.terms, kind="stable")
        self.docs = np.repeat(np.arange(self.n, dtype=np.int32), sizes)[order]
        self.posted = self.weight[order]
        self.starts = np.r_[0, np.cumsum(df)]

    def neighbours(self, seed: int, unused: np.ndarray, most: int) -> list[int]:
        """Unused documents by falling score for the seed's heaviest terms, ties to the earlier document."""
        own = slice(self.at[seed], self.at[seed + 1])
        terms = self.terms[own]
        if len(terms) > self.query_terms:
            terms = terms[np.argpartition(-self.weight[own], self.query_terms)[:self.query_terms]]
        spans = [(self.starts[t], self.starts[t + 1]) for t in terms.tolist()]
        docs = np.concatenate([self.docs[a:b] for a, b in spans])
        weights = np.concatenate([self.posted[a:b] for a, b in spans])
        scores = np.bincount(docs, weights, self.n)
        scores[~unused] = 0
        docs = np.flatnonzero(scores)
        if len(docs) > most:
            docs = docs[np.argpartition(-scores[docs], most - 1)[:most]]
        return docs[np.lexsort((docs, -scores[docs]))].tolist()


class Packer:
    """Windows of one shard; ``pieces`` holds finished rows until they are taken."""

    def __init__(self, shard: int, window: int, with_ids: bool):
        self.window, self.with_ids, self.base, self.count = window, with_ids, shard << 32, 0
        self.open: list[tuple] = []
        self.used = 0
        self.pieces: list[tuple] = []

    def _emit(self, parts: list[tuple]) -> None:
        offset, sequence = 0, self.base + self.count
        self.count += 1
        for doc, ids, start, stop in parts:
            own = ids[start:stop].astype("<u4")
            row = (doc, start, stop - start, zlib.crc32(own.tobytes()), len(ids), sequence, offset)
            self.pieces.append((*row, own.astype(np.int32)) if self.with_ids else row)
            offset += stop - start

    def place(self, doc, ids: np.ndarray) -> bool:
        """Put a document's ids down, closing windows on the way; whether one was closed."""
        start, closed = 0, False
        while start < len(ids):
            stop = min(len(ids), start + self.window - self.used)
            self.open.append((doc, ids, start, stop))
            self.used += stop - start
            start = stop
            if self.used == self.window:
                self._emit(self.open)
                self.open, self.used, closed = [], 0, True
        return closed

    def finish(self) -> None:
        """Cut the open window at sums of falling powers of two."""
        rest, size = self.open, self.window
        while rest:
            size //= 2
            if self.used < size:
                continue
            self.used -= size
            taken, room = [], size
            while room:
                doc, ids, start, stop = rest[0]
                cut = min(stop, start + room)
                taken.append((doc, ids, start, cut))
                room -= cut - start
                rest = rest[1:] if cut == stop else [(doc, ids, cut, stop), *rest[1:]]
            self._emit(taken)
        self.open = []


def pack_block(packer: Packer, keys: list, ids: list[np.ndarray], query_terms: int, neighbours: int, corpus: Weights) -> None:
    if not ids:
        return
    index, unused = Index(ids, query_terms, corpus), np.ones(len(ids), bool)
    for first in range(len(ids)):
        turn, seed, following = first if unused[first] else None, None, []
        while turn is not None:
            unused[turn] = False
            closed = packer.place(keys[turn], ids[turn])
            if seed is None or closed:
                seed, following = turn, index.neighbours(turn, unused, neighbours)
            turn = next((d for d in following if unused[d]), None)
            if turn is None and following:
                following = index.neighbours(seed, unused, neighbours)
                turn = next(iter(following), None)


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", json_path: str | None = None, window: int = WINDOW,
                   block_tokens: int = BLOCK_TOKENS, query_terms: int = QUERY_TERMS, neighbours: int = NEIGHBOURS,
                   shards: int | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: document, its start and length, CRC of its ids, sequence and offset; the ids too if asked for.

    ``json_path``: a tokenizer file that every executor can open; by default the public 50k byte-level one.
    """
    if window < 2 or window & (window - 1):
        raise ValueError("window must be a power of two above 1")
    shards = shards or common.partitions(docs.sparkSession)
    fields = _PIECE + ([("ids", pa.list_(pa.int32()))] if with_ids else [])
    arrow = pa.schema(fields)
    schema = T.StructType([T.StructField(n, T.ArrayType(T.IntegerType()) if n == "ids" else T.LongType()) for n, _ in fields])

    narrow = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
    stored = common.settle(_tokenised(narrow, json_path), "token-ids")
    corpus = _corpus_weights(stored)
    held = stored.filter("df IS NULL").drop("df", "tokens")
    quota = max(1, block_tokens // max(1, held.rdd.getNumPartitions()))

    def deal(batches):
        filled: dict[int, int] = {}
        for batch in batches:
            terms, turns = [], []
            for raw, wide in zip(batch.column(1), batch.column(2).to_pylist()):
                ids = read_ids(raw.as_buffer(), wide)
                term = corpus.sketch(ids)
                filled[term] = filled.get(term, 0) + len(ids)
                terms.append(term)
                turns.append((filled[term] - 1) // quota if term >= 0 else filled[term])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(terms, pa.int64()), pa.array(turns, pa.int64())], names=["key", "ids", "wide", "term", "turn"])

    def pack(batches):
        packer = Packer(TaskContext.get().partitionId(), window, with_ids)
        keys, held, size = [], [], 0

        def rows():
            out, packer.pieces = packer.pieces, []
            for at in range(0, len(out), _ROWS):
                columns = zip(*out[at:at + _ROWS])
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, fields)], schema=arrow)

        for batch in batches:
            for doc, raw, wide in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                keys.append(doc)
                held.append(read_ids(raw.as_py(), wide))
                size += len(held[-1])
                if size >= block_tokens:
                    pack_block(packer, keys, held, query_terms, neighbours, corpus)
                    keys, held, size = [], [], 0
                    yield from rows()
                    pa.default_memory_pool().release_unused()
        pack_block(packer, keys, held, query_terms, neighbours, corpus)
        packer.finish()
        yield from rows()

    dealt = held.mapInArrow(common.lean(deal), "key long, ids binary, wide boolean, term long, turn long")
    sharded = dealt.repartition(shards, F.xxhash64("term", "turn")).sortWithinPartitions("term", "turn", "key")
    return sharded.select("key", "ids", "wide").mapInArrow(common.lean(pack), schema)


_ID = np.dtype("<u4")


def _tokenised(docs: DataFrame, json_path: str | None) -> DataFrame:
    """(key, ids, wide, tokens, df): the ids of every text, in 32 bits where 16 do not do, and their number; and one row
    a task with ``df``, pairs of id and document frequency."""

    def encode_all(batches):
        import public_tokenizers

        path, ranks = json_path, None
        if path is None:
            path, ranks = public_tokenizers.path(f"{MERGES}.json"), public_tokenizers.path(f"{MERGES}.tiktoken")
        encode, end = encoder(path, ranks), np.array([END_ID], np.uint32)
        df = np.zeros(1 << 16, np.uint32)
        names, kinds = ["key", "ids", "wide", "tokens", "df"], (pa.int64(), pa.binary(), pa.bool_(), pa.int64(), pa.binary())
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part, out = batch.slice(at, _ROWS), [[], [], []]
                for value in common.texts(part.column(1)):
                    ids = np.concatenate([encode(value or ""), end])
                    wide = int(ids.max()) >= 1 << 16
                    ids = ids.astype(np.uint32 if wide else np.uint16)
                    own, _ = distinct(ids)
                    if own[-1] >= len(df):
                        df = np.r_[df, np.zeros(int(own[-1]) + 1 - len(df), np.uint32)]
                    df[own] += 1
                    for column, one in zip(out, (ids.tobytes(), wide, len(ids))):
                        column.append(one)
                columns = [part.column(0), *[pa.array(c, k) for c, k in zip(out, kinds[1:4])], pa.nulls(len(out[0]), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        there = np.flatnonzero(df)
        counts = np.stack([there.astype(np.uint32), df[there]], axis=1).astype(_ID).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((None, None, None, None, counts), kinds)], names=names)

    return docs.mapInArrow(common.lean(encode_all), "key long, ids binary, wide boolean, tokens long, df binary")


def _corpus_weights(stored: DataFrame) -> Weights:
    """Sums of the tasks' document frequencies: at most a row for each id of the vocabulary reaches the driver."""

    def spread(batches):
        for batch in batches:
            for raw in batch.column(0):
                pairs = np.frombuffer(raw.as_buffer(), _ID).reshape(-1, 2).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["term", "df"])

    size = stored.filter("df IS NULL").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens")).first()
    counts = stored.filter("df IS NOT NULL").select("df").mapInArrow(spread, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    df = np.zeros(max((r["term"] for r in counts), default=0) + 1, np.int64)
    for r in counts:
        df[r["term"]] = r["df"]
    return Weights(size["n"], (size["tokens"] or 0) / max(1, size["n"]), df)


def op6_lexical_packing(spark, sf_dir):
    """Every document's pieces in windows of 2,048 ids."""
    return pack_documents(common.table(spark, sf_dir, "documents"))
