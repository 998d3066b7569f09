"""Language-model scores by deleted interpolation.

P(w | v) mixes the bigram and unigram maximum-likelihood estimates and a uniform one. The mixture
depends on how often the context v occurs, by powers of two, and its weights are learned by
expectation-maximisation on tokens of a part of the training documents: each such document is held
out, its own counts deleted from those of the corpus.

Counts are exact and come from all training documents. Texts are read once and kept as chunks of
word numbers. A chunk asks for the counts of its distinct n-grams, bucket by bucket of their hash,
giving its own counts with the question; a bucket's task adds up what all chunks gave and answers
each. A word that is everywhere is one entry per chunk, so there are no hot keys. The exchange has
one row per chunk and bucket; where that would be very many, it goes in two levels: groups of chunks
put their questions together first, and hand the answers out among themselves.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityforge.llm.columns import Columns, as_columns, map_columns, names
from entityforge.llm.scratch import Scratch, partitions_for
from entityforge.llm.wordhash import WordHasher, mix

#: Tokens of a chunk, and tokens whose n-grams a bucket holds, about.
CHUNK_TOKENS, BUCKET_TOKENS = 2_000_000, 1_500_000
#: Folds of crc32(id) mod 5: not learned from at all; and the training documents that set the mixture.
TEST_FOLD, MIXTURE_FOLD, FOLDS = 1, 2, 5
#: Context-frequency buckets: 0, 1, 2 to 3, 4 to 7, and so on.
CONTEXTS = 24
#: Steps of a factor of two in the histogram that the weights are learned from, and where 1 lies.
STEPS, LOG_ZERO = 4, 400
#: Buckets from which the exchange has two levels, and distinct n-grams of a chunk, about.
TWO_LEVELS, CHUNK_KINDS = 4096, 1_200_000
#: N-grams of a group of chunks that one task puts together, about.
GROUP_KINDS = 4_000_000
#: Bits of the hashes by which words and pairs are counted: of 10^12 distinct pairs some 5 in 10^8 share a count with another.
WORD_BITS, PAIR_BITS = 58, 64
#: Stand for the end and the begin of a text among the hashes of words.
END, BEGIN = np.uint64(0x5EED_0E4D_0000_0001), np.uint64(0x5EED_0BE6_0000_0001)
NO_ID = -(1 << 63)
_P = np.uint64(0x9E3779B97F4A7C15)

_ZSTD = pa.Codec("zstd", compression_level=2)


def _small(numbers: np.ndarray) -> bytes:
    """Numbers of up to 64 bits, compressed byte by byte of all: ahead are their size and the bytes of a number, 4 or 8."""
    width = 8 if len(numbers) and int(numbers.max()) >> 32 else 4
    raw = np.ascontiguousarray(numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()
    return len(raw).to_bytes(8, "little") + bytes((width,)) + _ZSTD.compress(raw, asbytes=True)


def _large(raw: bytes) -> np.ndarray:
    size, width = int.from_bytes(raw[:8], "little"), raw[8]
    flat = _ZSTD.decompress(raw[9:], decompressed_size=size, asbytes=True) if size else b""
    return np.ascontiguousarray(np.frombuffer(flat, np.uint8).reshape(width, -1).T).view(f"<u{width}").ravel()


def _packed(keys: np.ndarray) -> bytes:
    """Sorted numbers: low bytes, which look random, as they are, and steps of what is above, compressed.

    Ahead: how many numbers, low bytes and bytes of a step there are, and the size of the steps.
    """
    spread = int(keys[-1] - keys[0]) // len(keys)
    low = max(spread.bit_length() - 1, 0) // 8
    high = keys >> np.uint64(8 * low) if low else keys
    steps = np.diff(high, prepend=np.uint64(0)).astype("<u8")
    steps[0], first = 0, int(high[0])
    width = max(1, -(-int(steps.max()).bit_length() // 8))
    tail = np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :low]).tobytes()
    planes = _ZSTD.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes(), asbytes=True)
    return b"".join((len(keys).to_bytes(8, "little"), bytes((low, width)), first.to_bytes(8, "little"), len(planes).to_bytes(8, "little"), planes, tail))


def _unpacked(raw: bytes) -> np.ndarray:
    n, low, width, first, size = int.from_bytes(raw[:8], "little"), raw[8], raw[9], int.from_bytes(raw[10:18], "little"), int.from_bytes(raw[18:26], "little")
    steps = np.zeros((n, 8), np.uint8)
    steps[:, :width] = np.frombuffer(_ZSTD.decompress(raw[26 : 26 + size], decompressed_size=n * width, asbytes=True), np.uint8).reshape(width, n).T
    high = np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64) + np.uint64(first)
    if not low:
        return high
    out = (high << np.uint64(8 * low)).astype("<u8").view(np.uint8).reshape(n, 8)
    out[:, :low] = np.frombuffer(raw, np.uint8, offset=26 + size).reshape(n, low)
    return out.view("<u8").ravel()


CHUNK = "chunk long, docs binary, folds binary, sizes binary, stream binary, vocab binary, n_tokens long, n_train long, n_begin long"


def fold_of(doc_id: int | None) -> int:
    """crc32 of the id as text, modulo 5; a null id is an empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS


def encode_chunks(docs: DataFrame) -> DataFrame:
    """Texts (doc, text) as chunks: ids, folds and sizes of documents, word numbers, and word hashes in order."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        hasher = WordHasher()
        part, made = TaskContext.get().partitionId(), 0
        docs_, folds, sizes, parts, held = [], [], [], [], 0

        def chunk() -> Columns:
            nonlocal made, docs_, folds, sizes, parts, held
            vocab, stream, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
            # frequent words get small numbers, which compress well
            order = np.argsort(-count, kind="stable")
            rank = np.empty(len(order), dtype=np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            train = np.array(folds) != TEST_FOLD
            row = (
                part << 32 | made, np.array(docs_, np.int64).tobytes(), np.array(folds, np.int8).tobytes(), np.array(sizes, np.int32).tobytes(),
                _small(rank[stream]), vocab[order].tobytes(), held, int(np.array(sizes)[train].sum()), int(train.sum()),
            )
            made += 1
            docs_, folds, sizes, parts, held = [], [], [], [], 0
            return as_columns([row], names(CHUNK))

        for batch in batches:
            for doc, words in zip(batch["doc"], hasher.all(batch["text"])):
                parts.append(np.append(words, END))
                docs_.append(NO_ID if doc is None else doc)
                folds.append(fold_of(doc))
                sizes.append(len(words) + 1)
                held += len(words) + 1
                if held >= CHUNK_TOKENS:
                    yield chunk()
        if docs_:
            yield chunk()

    return map_columns(docs, run, CHUNK)


class Chunk:
    """A decoded chunk with its distinct n-grams."""

    def __init__(self, row: dict):
        self.docs = np.frombuffer(row["docs"], np.int64)
        self.folds = np.frombuffer(row["folds"], np.int8)
        self.sizes = np.frombuffer(row["sizes"], np.int32)
        self.stream = _large(row["stream"]).astype(np.int32)
        self.vocab = np.frombuffer(row["vocab"], np.uint64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        word = self.vocab[self.stream]
        before = np.append(np.uint64(0), word[:-1])
        before[self.starts] = BEGIN
        pair = mix(before * _P + word)
        self.pair, self.before = pair, before
        self.pairs, self.pair_at = np.unique(pair, return_inverse=True)
        self.word_order = np.argsort(self.vocab)
        self.words = self.vocab[self.word_order] >> np.uint64(64 - WORD_BITS)
        self.doc_at = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.token_fold = self.folds[self.doc_at]

    def own_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each word, in hash order, and of each pair: the chunk's tokens in training documents."""
        train = self.token_fold != TEST_FOLD
        words = np.bincount(self.stream[train], minlength=len(self.vocab)).astype(np.uint32)[self.word_order]
        return words, np.bincount(self.pair_at[train], minlength=len(self.pairs)).astype(np.uint32)


ASKED = "bucket int, chunk long, keys binary, counts binary"


def _cuts(keys: np.ndarray, buckets: int, bits: int, first: int = 0, some: int | None = None) -> np.ndarray:
    """Where sorted keys pass from one bucket to the next, equal ranges: of all buckets, or of `some` from `first` on."""
    edges = np.array([(i << bits) // buckets for i in range(first + 1, first + (some or buckets))], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).astype(np.int64)


def _questions(chunks: DataFrame, levels: Levels) -> DataFrame:
    """Per chunk and bucket: sorted hashes, and the chunk's own counts of them. Words come in the first buckets."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            for i in range(len(batch["chunk"])):
                chunk = Chunk({k: v[i] for k, v in batch.items()})
                word_counts, pair_counts = chunk.own_counts()
                rows = []
                for keys, counts, (first, n, bits) in zip((chunk.words, chunk.pairs), (word_counts, pair_counts), levels.kinds()):
                    cuts = _cuts(keys, n, bits)
                    for b, (s, e) in enumerate(zip(cuts[:-1], cuts[1:])):
                        if e > s:
                            rows.append((first + b, batch["chunk"][i], _packed(keys[s:e]), _small(counts[s:e])))
                yield as_columns(rows, names(ASKED))

    return map_columns(chunks, run, ASKED)


ANSWER = "chunk long, bucket int, counts binary, kinds long"


def _answers(asked: DataFrame, partitions: int) -> DataFrame:
    """Corpus counts of every hash that was asked for, to each chunk; and a row per bucket (chunk -1)
    with the number of distinct n-grams in training."""

    def answer(rows: list[tuple]) -> Columns:
        bucket = rows[0][0]
        asked_keys = [_unpacked(r[2]) for r in rows]
        distinct, at = np.unique(np.concatenate(asked_keys), return_inverse=True)
        # sums of floats, exact up to 2^53
        total = np.bincount(at, np.concatenate([_large(r[3]) for r in rows]), minlength=len(distinct)).astype(np.uint64)
        out, start = [], 0
        for r, keys in zip(rows, asked_keys):
            out.append((r[1], bucket, _small(total[at[start : start + len(keys)]]), 0))
            start += len(keys)
        out.append((-1, bucket, None, int((total > 0).sum())))
        return as_columns(out, names(ANSWER))

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch[k] for k in names(ASKED))):
                if rows and row[0] != rows[0][0]:
                    yield answer(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield answer(rows)

    return map_columns(asked.repartitionById(partitions, F.col("bucket")).sortWithinPartitions("bucket", "chunk"), run, ANSWER)


@dataclass(frozen=True)
class Levels:
    """How the ranges of hashes are cut: buckets of words and of pairs, each cut again into `fine` ones, and groups of chunks."""

    words: int
    pairs: int
    fine: int = 1
    groups: int = 1

    @classmethod
    def of(cls, chunks: int, buckets: int) -> Levels:
        """One level as long as chunks times buckets are few rows; else two, about as many rows on either."""
        if buckets < TWO_LEVELS:
            return cls(max(4, buckets // 8), buckets)
        of_group = max(int(math.sqrt(buckets * GROUP_KINDS / CHUNK_KINDS)), 1)
        coarse = max(-(-of_group * CHUNK_KINDS // GROUP_KINDS), 1)
        return cls(max(1, coarse // 8), coarse, -(-buckets // coarse), max(-(-chunks // of_group), 1))

    def kinds(self) -> tuple[tuple[int, int, int], ...]:
        """(first bucket, buckets, bits of the hash) of words and of pairs."""
        return (0, self.words, WORD_BITS), (self.words, self.pairs, PAIR_BITS)


TOGETHER = "asker long, place int, bucket int, chunk long, keys binary, counts binary"


def _askers(asked: DataFrame, levels: Levels) -> DataFrame:
    """Questions with who asks them together: a group of chunks, for a bucket."""
    group = F.pmod(F.xxhash64("chunk"), F.lit(levels.groups))
    return asked.withColumn("asker", group * (levels.words + levels.pairs) + F.col("bucket"))


def _by_asker(batches: Iterator[Columns], keys: str) -> Iterator[list[tuple]]:
    """Rows in runs of one asker."""
    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch[k] for k in names(keys))):
            if rows and row[0] != rows[0][0]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _put_together(asked: DataFrame, levels: Levels, partitions: int) -> DataFrame:
    """Questions of whole groups: the distinct hashes of each bucket, cut into fine buckets, with the group's own counts."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for rows in _by_asker(batches, TOGETHER):
            asker, bucket = rows[0][0], rows[0][2]
            distinct, at = np.unique(np.concatenate([_unpacked(r[4]) for r in rows]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([_large(r[5]) for r in rows]), minlength=len(distinct)).astype(np.uint64)
            first, n, bits = levels.kinds()[bucket >= levels.words]
            cuts = _cuts(distinct, n * levels.fine, bits, (bucket - first) * levels.fine, levels.fine)
            found = [(bucket * levels.fine + f, asker, _packed(distinct[s:e]), _small(counts[s:e])) for f, (s, e) in enumerate(zip(cuts[:-1], cuts[1:])) if e > s]
            yield as_columns(found, names(ASKED))

    rows = _askers(asked, levels).withColumn("place", F.lit(1)).select(names(TOGETHER))
    return map_columns(rows.repartition(partitions, "asker").sortWithinPartitions("asker"), run, ASKED)


def _handed_out(asked: DataFrame, answers: DataFrame, levels: Levels, partitions: int) -> DataFrame:
    """Answers to whole groups, handed out to their chunks; the numbers of distinct n-grams pass through."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for rows in _by_asker(batches, TOGETHER):
            total = np.concatenate([_large(r[5]) for r in rows if r[1] == 0])
            asked_by = [(r[3], r[2], _unpacked(r[4])) for r in rows if r[1] == 1]
            _, at = np.unique(np.concatenate([keys for _, _, keys in asked_by]), return_inverse=True)
            out, start = [], 0
            for chunk, bucket, keys in asked_by:
                out.append((chunk, bucket, _small(total[at[start : start + len(keys)]]), 0))
                start += len(keys)
            yield as_columns(out, names(ANSWER))

    questions = _askers(asked, levels).withColumn("place", F.lit(1)).select(names(TOGETHER))
    nothing = F.lit(None).cast("binary").alias("keys")
    told = answers.filter("chunk >= 0").select(F.col("chunk").alias("asker"), F.lit(0).alias("place"), "bucket", F.lit(0).cast("long").alias("chunk"), nothing, "counts")
    laid = questions.unionByName(told).repartition(partitions, "asker").sortWithinPartitions("asker", "place", "bucket", "chunk")
    kinds = answers.filter("chunk < 0").withColumn("bucket", F.floor(F.col("bucket") / levels.fine).cast("int"))
    return map_columns(laid, run, ANSWER).unionByName(kinds)


JOINED = (
    "chunk long, docs binary, folds binary, sizes binary, stream binary, words binary, pairs binary, cells binary, cell_counts binary, kinds long"
)


def _own(doc: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """How often each token's kind occurs in its document."""
    _, at, n = np.unique(doc.astype(np.uint64) * _P + kind, return_inverse=True, return_counts=True)
    return n[at]


def _cells(chunk: Chunk, word: np.ndarray, pair: np.ndarray, n_train: int, n_begin: int) -> tuple[np.ndarray, np.ndarray]:
    """Held-out tokens by context bucket and by the logarithms of the two estimates without their own document."""
    pick = np.flatnonzero(chunk.token_fold == MIXTURE_FOLD)
    doc = chunk.doc_at[pick]
    context = np.append(0, word[:-1])
    context[chunk.starts] = n_begin
    others = context[pick] - _own(doc, chunk.before[pick])
    one = _divided((word[pick] - _own(doc, chunk.stream[pick].astype(np.uint64))).astype(float), (n_train - chunk.sizes[doc]).astype(float))
    two = _divided((pair[pick] - _own(doc, chunk.pair[pick])).astype(float), others.astype(float))
    logs = [np.where(x > 0, np.round(np.log2(np.where(x > 0, x, 1)) * STEPS) + LOG_ZERO, 0).astype(np.int64) for x in (one, two)]
    return np.unique((context_bucket(np.maximum(others, 0)) << 40) | (logs[0] << 20) | logs[1], return_counts=True)


def _join(chunks: DataFrame, answers: DataFrame, word_buckets: int, partitions: int, place: Column, n_train: int, n_begin: int) -> DataFrame:
    """Chunks with corpus counts: of each distinct word, and of the pair at each token; and the held-out
    tokens for the mixture. The numbers of distinct words pass through."""

    def joined(row: dict, words: list[bytes], pairs: list[bytes]) -> tuple:
        chunk = Chunk(row)
        of_word = np.empty(len(chunk.vocab), dtype=np.int64)
        of_word[chunk.word_order] = np.concatenate([_large(r) for r in words])
        of_pair = np.concatenate([_large(r) for r in pairs]).astype(np.int64)[chunk.pair_at]
        cells, n = _cells(chunk, of_word[chunk.stream], of_pair, n_train, n_begin)
        kept = (row[k] for k in ("chunk", "docs", "folds", "sizes", "stream"))
        return (*kept, _small(of_word), _small(of_pair), cells.astype(np.int64).tobytes(), n.astype(np.int64).tobytes(), 0)

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        row, words, pairs = None, [], []
        for batch in batches:
            out = []
            for i in range(len(batch["chunk"])):
                chunk, bucket = batch["chunk"][i], batch["bucket"][i]
                if bucket < 0:
                    if row is not None:
                        out.append(joined(row, words, pairs))
                    row, words, pairs = {k: batch[k][i] for k in names(CHUNK)}, [], []
                elif chunk < 0:
                    out.append((-1, *[None] * 8, batch["kinds"][i] if bucket < word_buckets else 0))
                else:
                    (words if bucket < word_buckets else pairs).append(batch["counts"][i])
            yield as_columns(out, names(JOINED))
        if row is not None:
            yield as_columns([joined(row, words, pairs)], names(JOINED))

    both = chunks.withColumn("bucket", F.lit(-1)).unionByName(answers, allowMissingColumns=True)
    return map_columns(both.repartitionById(partitions, place).sortWithinPartitions("chunk", "bucket"), run, JOINED)


def context_bucket(count: np.ndarray) -> np.ndarray:
    """0 for 0, else 1 more than the power of two."""
    return np.minimum(np.frexp(count.astype(float))[1], CONTEXTS - 1).astype(np.int64)


def _divided(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=b > 0)


def _histogram(joined: DataFrame) -> DataFrame:
    """(cell, n) over all chunks."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            for cells, n in zip(batch["cells"], batch["cell_counts"]):
                yield {"cell": np.frombuffer(cells, np.int64), "n": np.frombuffer(n, np.int64)}

    return map_columns(joined.select("cells", "cell_counts"), run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def learn_weights(cell: np.ndarray, n: np.ndarray, kinds: int, rounds: int = 200) -> np.ndarray:
    """Mixture weights (uniform, unigram, bigram) of each context bucket, by expectation-maximisation.

    A bucket starts from the weights of all buckets together, and a few pseudo-tokens hold it there,
    so that a bucket without held-out tokens has those.
    """
    bucket, q1, q2 = cell >> 40, (cell >> 20) & 0xFFFFF, cell & 0xFFFFF
    ratio = np.stack([np.ones(len(cell)), *(np.where(q > 0, np.exp2((q - LOG_ZERO) / STEPS) * (kinds + 1), 0.0) for q in (q1, q2))], axis=1)

    def fit(rows: np.ndarray, start: np.ndarray, pull: float) -> np.ndarray:
        w = start.copy()
        for _ in range(rounds):
            share = ratio[rows] * w
            share /= share.sum(axis=1, keepdims=True)
            new = (n[rows] @ share + pull * start) / (n[rows].sum() + pull)
            if np.abs(new - w).max() < 1e-9:
                break
            w = new
        return w

    everywhere = fit(np.ones(len(cell), bool), np.array([0.1, 0.6, 0.3]), 1.0)
    return np.stack([fit(bucket == b, everywhere, 5.0) for b in range(CONTEXTS)])


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(joined: DataFrame, tokens: int, kinds: int, n_begin: int, weights: np.ndarray) -> DataFrame:
    """Base and model score of every document."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            for i in range(len(batch["chunk"])):
                docs, folds, sizes = (np.frombuffer(batch[k][i], t) for k, t in (("docs", np.int64), ("folds", np.int8), ("sizes", np.int32)))
                starts = np.cumsum(sizes) - sizes
                word = _large(batch["words"][i]).astype(float)[_large(batch["stream"][i])]
                context = np.append(0.0, word[:-1])
                context[starts] = n_begin
                base = np.log10((word + 0.5) / (tokens + 0.5 * (kinds + 1)))
                w = weights[context_bucket(context)]
                pair = _large(batch["pairs"][i]).astype(float)
                p = w[:, 0] / (kinds + 1) + w[:, 1] * _divided(word, np.full(len(word), float(tokens))) + w[:, 2] * _divided(pair, context)
                yield {
                    "doc_id": [None if d == NO_ID else d for d in docs.tolist()], "held_out": (folds == TEST_FOLD).tolist(),
                    "n_tokens": sizes.astype(np.int64), "n_known": np.add.reduceat((word > 0).astype(np.int64), starts),
                    "train_tokens": np.full(len(docs), tokens, np.int64),
                    "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(np.log10(p), starts),
                }

    return map_columns(joined, run, SCORES)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: log10 probabilities of its whole text.

    Tokens are words with A-Z in lower case, then one end; a null or empty text is the end alone.
    Learns from rows whose crc32(id as text) mod 5 is not 1; of these, remainder 2 sets the mixture
    and then counts too. Rows that repeat an id are documents of their own. With nothing to learn
    from, all tokens are equally unknown. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    slim = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    chunks = scratch.write(encode_chunks(slim), "chunks")
    part, made = F.shiftright("chunk", 32), F.col("chunk").bitwiseAND(0xFFFFFFFF)
    sums = chunks.agg(F.count("*"), F.max(made), F.sum("n_tokens"), F.sum("n_train"), F.sum("n_begin")).first()
    n_chunks, most, n_tokens, n_train, n_begin = (x or 0 for x in sums)
    levels = Levels.of(n_chunks, max(partitions_for(spark), -(-n_tokens // BUCKET_TOKENS)))
    # a task for each bucket, and for each chunk, which are all of about one size
    buckets = (levels.words + levels.pairs) * levels.fine
    asked = _questions(chunks, levels)
    if levels.groups == levels.fine == 1:
        answers = _answers(asked, buckets)
    else:
        asked = scratch.write(asked, "asked")
        parts = max(partitions_for(spark), levels.groups * (levels.words + levels.pairs))
        answers = _handed_out(asked, scratch.write(_answers(_put_together(asked, levels, parts), buckets), "answers"), levels, parts)
    # chunks are numbered without large gaps, and dealt one to a task
    place = F.pmod(F.when(F.col("chunk") < 0, F.col("bucket").cast("long")).otherwise(part * (most + 1) + made), F.lit(max(partitions_for(spark), n_chunks))).cast("int")
    joined = scratch.write(_join(chunks, answers, levels.words, max(partitions_for(spark), n_chunks), place, n_train, n_begin), "joined")
    scratch.drop("asked", "answers")
    scratch.drop("chunks")
    kinds = joined.filter("chunk < 0").agg(F.sum("kinds")).first()[0] or 0
    held = joined.filter("chunk >= 0")
    cells = _histogram(held).toArrow()  # at most CONTEXTS times the steps of both logarithms
    weights = learn_weights(cells["cell"].to_numpy(), cells["n"].to_numpy().astype(float), kinds)
    return _score(held, n_train, kinds, n_begin, weights)
