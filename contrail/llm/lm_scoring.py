"""Scoring of whole documents by a gated recurrent language model learned from the corpus."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm import recurrent
from contrail.llm.common import small_batches
from contrail.llm.labelled import fit_in_one_task
from contrail.scratch import materialise

_CHUNK = 4096
_PIECE_BYTES = 2**26


@dataclass(frozen=True)
class Settings:
    """``explicit`` words have an output of their own; ``known`` at most are broadcast with their
    counts. All other words are counted exactly too, but through joins. ``stride``: gradient steps
    take one excerpt in so many of the training documents laid end to end; 1 takes every token, and
    more leaves out short documents whole. ``rounds``: how often the replicas of the tasks are
    averaged; each round learns from its share of the documents."""

    explicit: int = 2048
    known: int = 65_536
    classes: int = 32
    tails: int = 24
    hidden: int = 24
    warm_up_docs: int = 400
    rounds: int = 3
    stride: int = 1
    rate: float = 0.05
    chunk_tokens: int = 2_000_000
    seed: int = 5


def tail_class(word: bytes, tails: int) -> int:
    return zlib.crc32(word[-2:]) % tails


def _tail_class_column(word: Column, tails: int) -> Column:
    return F.crc32(F.substring(F.encode(word, "utf-8"), -2, 2)) % tails


# Words ------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Piece:
    """Some rows of a task and their words, as of :func:`common.words`: ``words`` end to end, with
    ``counts`` of them per row."""

    rows: pa.Table
    words: pa.ChunkedArray
    counts: np.ndarray


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    found, row = parts.flatten(), np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy())
    real = pc.greater(pc.binary_length(found), 0)  # white space at an end makes an empty part
    return found.filter(real), np.bincount(row[real.to_numpy(zero_copy_only=False)], minlength=len(texts))


def pieces(batches: Iterator[pa.RecordBatch], tokens: int) -> Iterator[Piece]:
    """The batches' rows, with their ``text`` taken apart, in pieces of just over ``tokens`` words
    and end marks, or fewer if their text is long."""
    rows, found, counts, size, room = [], [], [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column("text")
        some, n = _split(texts)
        rows.append(batch.drop_columns(["text"]))
        found.append(some)
        counts.append(n)
        size, room = size + len(some) + len(n), room + texts.nbytes
        if size > tokens or room > _PIECE_BYTES:
            yield Piece(pa.Table.from_batches(rows), pa.chunked_array(found), np.concatenate(counts))
            rows, found, counts, size, room = [], [], [], 0, 0
    if rows:
        yield Piece(pa.Table.from_batches(rows), pa.chunked_array(found), np.concatenate(counts))


# Counts -----------------------------------------------------------------------------------------


def word_counts(train: DataFrame) -> DataFrame:
    """``word`` and ``n`` over all training texts, without the end marks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, 4_000_000):
            found = pc.value_counts(piece.words)
            yield pa.record_batch([found.field("values").cast(pa.string()), found.field("counts")], ["word", "n"])

    found = train.select("text").mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _least_count(counts: DataFrame, known: int) -> int:
    """The least count such that at most ``known`` words have it or more. Counts are tallied in 16
    steps per power of two, so the driver gets a few hundred rows at most."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    tally = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()
    left, least = known, None
    for row in sorted(tally, reverse=True):
        if row["n"] > left:
            break
        left, least = left - row["n"], row["step"]
    return int(np.ceil(2 ** (least / 16) - 1e-9)) if least is not None else 2**62


@dataclass(frozen=True)
class Corpus:
    """What all tasks need to know of the training corpus; bounded by the settings."""

    words: pa.Array  # the known words and the end mark "", by their places in the next two
    end: int  # place of the end mark
    id_of: np.ndarray
    count_of: np.ndarray
    tokens: int
    types: int
    tail_mass: np.ndarray  # tokens and types + 1 of each tail class
    ids: np.ndarray  # count of every id of the model
    starts: tuple[int, ...]


def _plain(corpus: Corpus) -> tuple:
    """For a broadcast: the fields alone, so that workers need not import the class."""
    return tuple(getattr(corpus, f.name) for f in fields(corpus))


def measure(train: DataFrame, counts: DataFrame, settings: Settings) -> Corpus:
    """``counts`` is the written result of :func:`word_counts`. Words of equal count are taken in
    the order of their bytes."""
    texts = train.count()
    tokens, types = counts.agg(F.sum("n"), F.count("*")).first()
    tokens, types = (tokens or 0) + texts, types + (texts > 0)
    least = _least_count(counts, settings.known)
    known = [(r["word"].encode(), r["n"]) for r in counts.filter(F.col("n") >= least).collect()]
    known = sorted([*known, (b"", texts)], key=lambda x: (-x[1], x[0]))
    end = next(x for x in known if not x[0])
    top = sorted({*known[: settings.explicit - 1], end}, key=lambda x: (-x[1], x[0]))
    explicit = {w: k for k, (w, _) in enumerate(top)}
    tails, n_words = settings.tails, len(explicit)
    mass = np.zeros((tails, 2))
    for row in (
        counts.groupBy(_tail_class_column(F.col("word"), tails).alias("tail"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("v"))
        .collect()
    ):
        mass[row["tail"]] += row["n"], row["v"]
    for w, n in top:
        if w:
            mass[tail_class(w, tails)] -= n, 1
    by_id = np.append([n for _, n in top], mass[:, 0])
    places = pa.array([w.decode() for w, _ in known], pa.string())
    id_of = [explicit[w] if w in explicit else n_words + tail_class(w, tails) for w, _ in known]
    count_of = np.array([n for _, n in known], np.float64)
    starts = recurrent.class_starts(by_id[:n_words] + 1, settings.classes)
    sums = mass.sum(1) + 1
    return Corpus(places, known.index(end), np.array(id_of, np.int32), count_of, tokens, types, sums, by_id, starts)


# Learning ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Tokens:
    """The tokens of a piece, an end mark after each row's words: their ids; their places among the
    known words (-1: not there); where each row's tokens end; and the words that are not known."""

    ids: np.ndarray
    places: np.ndarray
    ends: np.ndarray
    unknown: pa.ChunkedArray

    def by_row(self) -> list[np.ndarray]:
        return np.split(self.ids, self.ends[:-1])


def lookup(piece: Piece, corpus: Corpus, n_words: int) -> Tokens:
    ends = np.cumsum(piece.counts + 1)
    found = pc.index_in(piece.words, value_set=corpus.words.cast(piece.words.type))
    unknown = piece.words.filter(pc.is_null(found))
    places = np.full(ends[-1], corpus.end, np.int64)
    word = np.ones(len(places), bool)
    word[ends - 1] = False
    places[word] = pc.fill_null(found, -1).to_numpy()
    ids, tails = corpus.id_of[places], len(corpus.tail_mass)
    ending = pc.binary_slice(unknown.cast(pa.large_binary()), -2).combine_chunks().dictionary_encode()
    classes = np.array([tail_class(w, tails) for w in ending.dictionary.to_pylist()], np.int32)
    ids[places < 0] = n_words + classes[ending.indices.to_numpy()]
    return Tokens(ids, places, ends, unknown)


def _sum_chunks(parts: DataFrame) -> DataFrame:
    """Sums ``values`` per ``chunk`` and salt, then per chunk: a group holds a bounded part of what
    the tasks send."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(rows["values"].to_list()), 0)
        return pd.DataFrame({"chunk": rows["chunk"][:1], "n": [rows["n"].sum()], "values": [total]})

    schema = "chunk int, n double, values array<double>"
    salted = parts.withColumn("salt", F.spark_partition_id() % 64)
    some = salted.groupBy("chunk", "salt").applyInPandas(add, schema)
    return some.groupBy("chunk").applyInPandas(add, schema)


def learn(train: DataFrame, corpus: Corpus, settings: Settings) -> tuple[recurrent.Shape, np.ndarray]:
    """The model: a start on a bounded number of documents in one task, then ``rounds`` in which
    every task learns a replica from its documents and the replicas are averaged, weighted by their
    tokens. Every training document takes part in one round, with all its tokens if ``stride`` is 1."""
    shape = recurrent.Shape(corpus.starts, settings.tails, settings.hidden)
    flat = recurrent.first_weights(shape, corpus.ids, settings.seed)
    texts, n_words = corpus.count_of[corpus.end], shape.words
    context = train.sparkSession.sparkContext
    known = context.broadcast(_plain(corpus))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(settings.seed)), F.lit(2**31))
    share = min(1.0, settings.warm_up_docs / max(texts, 1))

    def begin(rows: pd.DataFrame) -> tuple:
        own, memory = flat.copy(), np.full_like(flat, 1e-6)
        texts = pa.record_batch([pa.array(rows["text"], pa.string(), from_pandas=True)], ["text"])
        for piece in pieces([texts], len(rows) + texts.nbytes):
            docs = lookup(piece, Corpus(*known.value), n_words).by_row()
            recurrent.learn(own, shape, docs, memory, settings.rate)
        return own, memory

    start = train.filter(draw < int(share * 2**31)).select("text")
    flat, memory = fit_in_one_task(start, begin, (flat, np.full_like(flat, 1e-6)))
    for k in range(settings.rounds):
        state = context.broadcast((flat, memory))

        def replica(batches, state=state):
            own, held = state.value[0].copy(), state.value[1].copy()
            total, own_corpus = 0, Corpus(*known.value)
            for piece in pieces(batches, settings.chunk_tokens // 4):
                docs = lookup(piece, own_corpus, n_words).by_row()
                recurrent.learn(own, shape, docs, held, settings.rate, settings.stride)
                total += sum(map(len, docs))
            if total:
                both = np.stack([own, held]).astype(np.float64).ravel() * total
                cut = np.arange(0, len(both) + _CHUNK, _CHUNK).clip(max=len(both)).astype(np.int32)
                n, chunk = len(cut) - 1, np.arange(len(cut) - 1, dtype=np.int32)
                values = pa.ListArray.from_arrays(pa.array(cut), pa.array(both))
                yield pa.record_batch([chunk, np.full(n, float(total)), values], ["chunk", "n", "values"])

        own = train.filter(F.pmod(F.xxhash64("doc_id"), F.lit(settings.rounds)) == k).select("text")
        parts = own.mapInArrow(replica, "chunk int, n double, values array<double>")
        rows = sorted(_sum_chunks(parts).collect(), key=lambda r: r["chunk"])
        if rows:
            both = np.concatenate([np.array(r["values"]) / r["n"] for r in rows]).astype(np.float32)
            flat, memory = both.reshape(2, -1)
    return shape, flat


# Scoring ----------------------------------------------------------------------------------------

_SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
    "score double, rest array<struct<word:string,times:int>>"
)


def score_texts(docs: DataFrame, corpus: Corpus, shape: recurrent.Shape, flat: np.ndarray, settings: Settings) -> DataFrame:
    """What a task can say about its documents alone: all but the counts of the words that are not
    broadcast, which ``rest`` lists."""
    context = docs.sparkSession.sparkContext
    known, weights = context.broadcast(_plain(corpus)), context.broadcast(flat)
    floor, n_words = float(np.log10(corpus.tokens + corpus.types + 1)), shape.words
    names = [c.split()[0] for c in _SCORED.split(", ")]

    def rest(found: Tokens) -> pa.ListArray:
        """Per row its words that are not known, each once, and how often they occur."""
        row = np.searchsorted(found.ends, np.flatnonzero(found.places < 0), "right")
        coded = found.unknown.cast(pa.string()).combine_chunks().dictionary_encode()
        n = max(len(coded.dictionary), 1)
        pairs, times = np.unique(row * n + coded.indices.to_numpy(), return_counts=True)
        found_words = coded.dictionary.take(pa.array(pairs % n))
        pairs_of = pa.StructArray.from_arrays([found_words, pa.array(times.astype(np.int32))], ["word", "times"])
        offsets = np.searchsorted(pairs // n, np.arange(len(found.ends) + 1))
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pairs_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Corpus(*known.value)
        # A place of -1 is the last one: an unseen word, until its count is joined.
        logs_of, in_tail = np.append(np.log10(own.count_of + 1), 0.0), np.log10(own.tail_mass)
        seen = np.append(own.count_of > 0, False)
        for piece in pieces(batches, settings.chunk_tokens):
            found = lookup(piece, own, n_words)
            starts, logs = np.append(0, found.ends[:-1]), logs_of[found.places]
            lengths = found.ends - starts
            n_known = np.add.reduceat(seen[found.places], starts, dtype=np.int64)
            base = np.add.reduceat(logs, starts) - lengths * floor
            outside = found.ids < n_words
            logs -= in_tail[np.where(outside, 0, found.ids - n_words)]
            logs[outside] = 0
            nats = recurrent.score(weights.value, shape, found.by_row())
            score = np.add.reduceat(logs, starts) + nats / np.log(10)
            given = (piece.rows.column(c).combine_chunks() for c in names[:2])
            yield pa.record_batch([*given, *map(pa.array, (lengths, n_known, base, score)), rest(found)], names)

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, _SCORED)


def lm_score(docs: DataFrame, held_out: Column, settings: Settings = Settings()) -> DataFrame:
    """Scores every document of ``docs`` (integer ``doc_id``, ``text``) by a model that learns from
    those that are not ``held_out``.

    Returns one row per row of ``docs``, repeated rows and null ids included: ``doc_id``,
    ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (unigram, add one) and
    ``score``, both log10. A word's probability is that of its class given the state, times that of
    the word in its class: a softmax for explicit words, counts plus one for the others, where one
    more type stands for all words unseen in training. Null and empty texts are one end mark. Without
    training documents every token has an unseen word's probability. Other columns are ignored.
    """
    small_batches(docs.sparkSession, 128)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"))
    train = docs.filter(~F.col("held_out"))
    counts = materialise(word_counts(train), "word-counts")
    corpus = measure(train, counts, settings)
    shape, flat = learn(train, corpus, settings)
    scored = score_texts(docs, corpus, shape, flat, settings)
    scored = materialise(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    # Words that are not broadcast are too rare to skew the join, but for unseen ones.
    rest = scored.select("row", F.explode("rest").alias("r")).select("row", "r.word", "r.times")
    rest = rest.join(counts, "word")
    found = rest.groupBy("row").agg(
        F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("logs")
    )
    more, logs = F.coalesce("more", F.lit(0)), F.coalesce("logs", F.lit(0.0))
    return scored.drop("rest").join(found, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + more).cast("long").alias("n_known"),
        F.lit(corpus.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + logs).alias("base_score"),
        (F.col("score") + logs).alias("score"),
    )
