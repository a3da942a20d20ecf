"""Log-likelihoods of whole documents by a recurrent language model trained on the corpus.

Counts of all words of all training documents decide the vocabulary, its classes and the
probabilities of words that are not frequent. The network learns from every token of every training
document, its state carried from end to end. The documents are dealt by digest to learners, and
those of each learner to SLICES slices. All learners go through a slice from the same weights, which are
then averaged, by tokens learned, for the next slice. How many learners there are follows from
the number of training tokens alone, so scores do not depend on tasks, files or settings. All documents
are then scored from end to end.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import gru
from lakemart.llm.common import crc_remainder, documents, release_memory, shuffle_tasks, stored, whole_texts
from lakemart.llm.groups import GROUP_BYTES, batches_of, cut, group_texts, grouped, pack_numbers, unpack_all

HELD_OUT = (7, 2)
#: Parts of the one pass over the training documents, with averaged weights after each.
SLICES = 4
#: Training tokens of a learner, about.
LEARNER_TOKENS = 4_000_000
#: Tokens that one call of the scorer, or one part of the training, runs side by side, about.
TOKENS_PER_CALL = 2_400_000
#: The end of a document as a token; words hold no space.
END = b" "


def bytes_of(strings: pa.Array) -> list[bytes]:
    """Strings as bytes; faster than ``to_pylist``, and ``to_numpy`` would load pandas into every worker."""
    if not len(strings):
        return []
    strings = strings.cast(pa.large_binary())
    _, offsets, data = strings.buffers()
    ends = np.frombuffer(offsets, np.int64, len(strings) + 1, 8 * strings.offset).tolist()
    data = data.to_pybytes()
    return [data[a:b] for a, b in itertools.pairwise(ends)]


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the distinct tokens of texts, the place among them of every token, text after text, and
    how many tokens there are up to the end of each text. The end of a text is the last name.

    Names have 64 bits. Two words of a billion share one with a chance of about 1 in 40.
    """
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts))  # only A-Z and ASCII white space
    offsets = words.offsets.to_numpy().astype(np.int64)
    flat = words.flatten()
    real = pc.binary_length(flat).to_numpy() > 0  # not so before and after white space at the ends
    if not real.all():
        offsets = np.append(0, np.cumsum(real))[offsets - offsets[0]]
        flat = flat.filter(pa.array(real))
    flat = flat.dictionary_encode()
    distinct = [*bytes_of(flat.dictionary), END]
    names = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))
    ends = np.cumsum(np.diff(offsets) + 1)
    at = np.full(len(flat) + len(ends), len(names) - 1, np.int32)
    inside = np.ones(len(at), bool)
    inside[ends - 1] = False
    at[inside] = flat.indices.to_numpy()
    return names, at, ends


def band_of(counts: np.ndarray) -> np.ndarray:
    """Class of words that are not frequent: 0 for counts up to 1, else the bits of the count less 1."""
    return np.minimum(gru.BANDS - 1, np.log2(np.maximum(counts, 1)).astype(np.int64) + (counts > 1))


def is_held_out(doc) -> bool:
    return zlib.crc32(str(doc).encode()) % HELD_OUT[0] == HELD_OUT[1] if doc is not None else False


def word_counts(dealt: DataFrame, tasks: int) -> DataFrame:
    """(grp, counts, n, v, hash, count): for each group the counts of its words in all training documents.

    Rows without a group hold sums for one task: its training tokens (n), distinct training words
    (v), tokens and words by band, and its most frequent words.
    """
    schema = "task int, blob binary"
    answer = "grp int, counts binary, n bigint, v bigint, hash bigint, count bigint, band int"

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))]
        for batch in batches:
            for group, at in cut(batch.column(2).to_numpy()):
                part = batch.take(pa.array(at))
                names, at, ends = tokens_of(part.column(1))
                learned = ~np.fromiter(map(is_held_out, part.column(0).to_pylist()), bool, part.num_rows)
                learned = at[np.repeat(learned, np.diff(ends, prepend=0))]
                held.append((names, np.bincount(learned, minlength=len(names)), np.full(len(names), group)))
        # One blob for each task that this one sends to, whatever the number of groups.
        names, counts, group = (np.concatenate(x) for x in zip(*held, strict=True))
        to = (names % np.uint64(tasks)).astype(np.min_scalar_type(tasks))  # few bytes are sorted faster
        found = [(t, pack_numbers((names[at], 8), (counts[at], 8), (group[at], 4))) for t, at in cut(to)]
        del names, counts, group, held
        yield batches_of(schema, [t for t, _ in found], [b for _, b in found])
        del found
        release_memory()

    def total(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, counts, group = unpack_all((b for batch in batches for b in batch.column(1).to_pylist()), 8, 8, 4)
        if not len(names):
            return
        distinct, place = np.unique(names, return_inverse=True)
        sums = np.bincount(place, counts, len(distinct)).astype(np.int64)
        rows = [(g, pack_numbers((names[at], 8), (sums[place[at]], 8)), None, None, None, None, None) for g, at in cut(group.astype(np.int64))]
        band = band_of(sums)
        for b in np.unique(band[sums > 0]).tolist():
            own = sums[(band == b) & (sums > 0)]
            rows.append((None, None, int(own.sum()), len(own), None, None, b))
        # Ties as Spark orders them, so that the choice does not depend on which words share a task.
        most = np.lexsort((distinct.view(np.int64), -sums))[: gru.HEAD_WORDS]
        rows += [(None, None, None, None, int(h), int(c), None) for h, c in zip(distinct[most].view(np.int64), sums[most], strict=True) if c > 0]
        del names, counts, group, distinct, place, sums, band
        yield batches_of(answer, *map(list, zip(*rows, strict=True)))
        del rows
        release_memory()

    return dealt.mapInArrow(count, schema).repartition(tasks, "task").mapInArrow(total, answer)


class Vocabulary:
    """Frequent words, and sums over all words; its size is bounded whatever the corpus."""

    def __init__(self, counts: DataFrame):
        top = counts.filter("hash is not null").orderBy(F.desc("count"), "hash").limit(gru.HEAD_WORDS).select("hash", "count").collect()
        bands = {r["band"]: (r["n"], r["v"]) for r in counts.filter("band is not null").groupBy("band").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()}
        self.head = np.array([r["hash"] for r in top], np.int64).view(np.uint64)
        self.head_counts = np.array([r["count"] for r in top], np.int64)
        self.tokens = sum(n for n, _ in bands.values())
        self.words = sum(v for _, v in bands.values())
        tail = np.zeros((gru.BANDS, 2), np.int64)
        for b, (n, v) in bands.items():
            tail[b] = n, v
        head_band = band_of(self.head_counts)
        np.subtract.at(tail[:, 0], head_band, self.head_counts)
        np.subtract.at(tail[:, 1], head_band, 1)
        self.band_tokens, self.band_words = tail.T
        self.order = np.argsort(self.head)

    def initial(self) -> gru.Weights:
        by_word = np.zeros(gru.HEAD_WORDS)
        by_word[: len(self.head_counts)] = self.head_counts
        return gru.initial(np.concatenate([by_word.reshape(gru.HEAD_CLASSES, -1).sum(axis=1), self.band_tokens]), by_word)

    def numbers(self, names: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token numbers of words, and the natural log of each word's share of its band."""
        band = band_of(counts)
        number = gru.HEAD_WORDS + band
        # Words seen once share their band evenly with the words not seen at all.
        share = np.where(counts > 1, counts / np.maximum(self.band_tokens[band], 1), 1 / (self.band_words[band] + 1))
        share = np.log(np.maximum(share, 1e-300))
        if len(self.head):
            ranked = self.head[self.order]
            at = np.minimum(np.searchsorted(ranked, names), len(ranked) - 1)
            frequent = ranked[at] == names
            number[frequent] = self.order[at[frequent]]
            share[frequent] = 0.0
        return number, share


ENCODED = "doc_id bigint, n_tokens bigint, n_known bigint, base double, rest double, ids binary"


def encoded(texts: DataFrame, counts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Token numbers of every document, its base score, and the part of its score that counts decide."""
    from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField, StructType

    kinds = {"bigint": (LongType(), pa.int64()), "double": (DoubleType(), pa.float64()), "binary": (BinaryType(), pa.binary())}
    fields = [tuple(f.split()) for f in ENCODED.split(", ")]
    schema, arrow = StructType([StructField(n, kinds[k][0]) for n, k in fields]), pa.schema([(n, kinds[k][1]) for n, k in fields])
    whole = vocabulary.tokens + (vocabulary.words + 1)

    def encode(texts: pa.Table, counts: pa.Table) -> pa.Table:
        names, totals = unpack_all(counts.column("counts").to_pylist(), 8, 8)
        order = np.argsort(names)
        names, totals = names[order], totals[order].astype(np.int64)

        def numbered(rows: list[pa.Table]) -> pa.RecordBatch:
            rows = pa.concat_tables(rows).combine_chunks().to_batches()[0]
            own, at, ends = tokens_of(rows.column(1).view(pa.string()))
            order, seen = np.argsort(own), np.empty(len(own), np.int64)
            seen[order] = totals[np.searchsorted(names, own[order])]  # names in order are found faster
            number, share = vocabulary.numbers(own, seen)
            starts = np.append(0, ends[:-1])
            sums = [np.add.reduceat(x[at], starts) for x in ((seen > 0).astype(np.int64), np.log10((seen + 1) / max(whole, 1)), share)]
            ids = pa.py_buffer(number.astype("<u2")[at])
            ids = pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.append(0, 2 * ends).astype(np.int32)), ids])
            return pa.RecordBatch.from_arrays([rows.column(0).cast(pa.int64()), pa.array(ends - starts), *map(pa.array, sums), ids], schema=arrow)

        # A group is larger than others only by equal rows; it is read in parts.
        parts, held, size = [], [], 0
        for blob in texts.column("texts").to_pylist():
            held.append(pa.ipc.open_stream(blob).read_all())
            size += held[-1].nbytes
            if size >= 2 * GROUP_BYTES:
                parts.append(numbered(held))
                held, size = [], 0
        if held:
            parts.append(numbered(held))
        table = pa.Table.from_batches(parts, arrow)
        del names, totals, order, parts
        release_memory()
        return table

    return texts.groupBy("grp").cogroup(counts.groupBy("grp")).applyInArrow(encode, schema)


def lessons(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[list[np.ndarray]]]]:
    """Each learner with its documents' token numbers, in lists of about TOKENS_PER_CALL tokens, of
    rows (learner, ids) sorted by learner."""
    rows = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))

    def parts(own: Iterable[tuple[int, bytes]]) -> Iterator[list[np.ndarray]]:
        held, tokens = [], 0
        for _, ids in own:
            held.append(np.frombuffer(ids, "<u2"))
            tokens += len(held[-1])
            if tokens >= TOKENS_PER_CALL:
                yield held
                held, tokens = [], 0
        if held:
            yield held

    for learner, own in itertools.groupby(rows, lambda row: row[0]):
        yield learner, parts(own)


def trained(corpus: DataFrame, weights: gru.Weights, tokens: int) -> gru.Weights:
    """Weights after one pass over the training documents of ``corpus``, which hold about ``tokens`` tokens.

    A document's digest, of its id and token numbers, names its learner and its slice; equal rows
    have the same. A learner takes its documents in the order of their ids and token numbers.
    """
    learners = max(1, -(-tokens // LEARNER_TOKENS))
    share = max(1, math.isqrt(learners))
    schema = "weights binary, tokens double, part int"
    training = corpus.filter(F.coalesce(crc_remainder("doc_id", HELD_OUT[0]) != HELD_OUT[1], F.lit(True))).select(
        F.pmod(F.xxhash64("doc_id", "ids"), F.lit(learners)).cast("int").alias("learner"),
        F.pmod(F.xxhash64("ids", "doc_id", F.lit(1)), F.lit(SLICES)).alias("slice"),
        "doc_id", "ids",
    )

    def sums(values: Iterable[tuple[bytes, float]], part: int) -> Iterator[pa.RecordBatch]:
        """Weights averaged by tokens, and these tokens; no rows without tokens."""
        total, tokens = 0.0, 0.0
        for raw, n in values:
            total += np.frombuffer(raw, "<f4").astype(np.float64) * n
            tokens += n
        if tokens:
            raw = (total / tokens).astype("<f4").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([raw], pa.binary()), pa.array([tokens]), pa.array([part], pa.int32())], names=["weights", "tokens", "part"])

    def learner(start: bytes):
        def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for name, parts in lessons(batches):
                count = 0

                def counted() -> Iterator[list[np.ndarray]]:
                    nonlocal count
                    for documents in parts:
                        count += sum(map(len, documents))
                        yield documents

                after = gru.pack(gru.train(gru.unpack(start), counted()))
                yield from sums([(after, float(count))], name % share)
            release_memory()

        return learn

    def average(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from sums(((row["weights"], row["tokens"]) for batch in batches for row in batch.to_pylist()), 0)

    for number in range(SLICES):
        own = training.filter(F.col("slice") == number).repartition(learners, "learner")
        own = own.sortWithinPartitions("learner", "doc_id", "ids").select("learner", "ids")
        after = own.mapInArrow(learner(gru.pack(weights)), schema)
        # Averaged in two steps, so that no task and not the driver gets the weights of all learners.
        some = after.repartition(share, "part").mapInArrow(average, schema)
        found = some.repartition(1).mapInArrow(average, schema).collect()
        if found:
            weights = gru.unpack(found[0]["weights"])
    return weights


def scored(corpus: DataFrame, weights: gru.Weights) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) in log10."""
    raw = gru.pack(weights)
    schema = "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = gru.unpack(raw)

        def done(rows: list[dict]) -> pa.RecordBatch:
            logs = gru.score(own, [np.frombuffer(r["ids"], "<u2") for r in rows])
            values = [(r["doc_id"], r["n_tokens"], r["n_known"], r["base"], (r["rest"] + x) / math.log(10)) for r, x in zip(rows, logs.tolist(), strict=True)]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*values, strict=True), kinds, strict=True)], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

        held, tokens = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                held.append(row)
                tokens += row["n_tokens"]
                if tokens >= TOKENS_PER_CALL:
                    yield done(held)
                    held, tokens = [], 0
        if held:
            yield done(held)
        del held
        release_memory()

    return corpus.mapInArrow(run, schema)


def log_likelihoods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    A null text counts as empty: its only token is the end. Repeated rows each give a row and each
    count in training; a null id counts as a training document; an empty table gives no rows;
    other columns are not read. Ids must be whole numbers. Without training documents every word
    is unseen and the network stays as it starts.
    """
    rows = whole_texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    dealt, total = grouped(rows)
    # As many tasks as groups, however the session is set, so that none grows with the documents.
    tasks = max(shuffle_tasks(docs.sparkSession), -(-total // GROUP_BYTES))
    texts = group_texts(dealt).repartition(tasks, "grp")
    counts = stored(word_counts(dealt, tasks), "word-counts")
    vocabulary = Vocabulary(counts)
    of_groups = counts.filter("counts is not null").select("grp", "counts").repartition(tasks, "grp")
    corpus = stored(encoded(texts, of_groups, vocabulary), "encoded-documents")
    weights = trained(corpus, vocabulary.initial(), vocabulary.tokens)
    return scored(corpus, weights).select(
        "doc_id",
        F.coalesce(crc_remainder("doc_id", HELD_OUT[0]) == HELD_OUT[1], F.lit(False)).alias("held_out"),
        "n_tokens", "n_known",
        F.lit(vocabulary.tokens).cast("bigint").alias("train_tokens"),
        "base_score", "score",
    )


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities of all documents."""
    return log_likelihoods(documents(spark, sf_dir))
