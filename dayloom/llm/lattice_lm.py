"""Language-model scores by the marginal likelihood of a subword lattice.

The model draws subword pieces one after the other from one distribution until it draws the end. A text can be spelled by many
sequences of pieces; its probability is the sum over all of them, which a forward recursion in log space gives in one
walk over its bytes. No piece holds a blank but as its first character, so the lattice of a text falls apart at its
words, and a text's log10 probability is the sum of its words', plus that of the end.

Pieces and their first weights are those of an existing vocabulary file (sentencepiece): a unigram file's own log
probabilities; the rank r by score in a merge file, whose scores are no probabilities, as ``1 / (r + OFFSET)``. ``fit`` then
re-estimates the weights on the training texts by expectation maximisation: expected uses of each piece over all
segmentations of all training words, plus ``PRIOR`` uses spread by the first weights. Every byte is a piece, so each
text has a probability.

Words are runs of characters other than space and ``\\t \\n \\v \\f \\r`` with A-Z lower-cased, then one end. Beside the
model's there is a base score: the word unigram with one added to each count.

How it runs: words are counted per task and summed by one shuffle, over all texts; the lattice is walked once per distinct
word, not per occurrence. The ``HOT`` most frequent words of at most ``LONGEST_HOT`` bytes (25 MB at most) are broadcast;
each text adds up those in one pass and writes the others beside its sums, and these, none of which is frequent, meet their
word by a shuffle. What is broadcast else are the weights of the vocabulary's pieces.

Defined results: a null or empty text is the end alone; rows are scored one by one, so equal rows get equal scores and each
row stays; a null ``doc_id`` counts as an empty one; without training texts all counts are 0 and the first weights score; an
empty table gives no rows; other columns are not read. Expected uses are summed in whole units of 2^-16, so the weights do not
depend on the order of summation.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from dayloom.llm.heads import head
from dayloom.session import stored

OFFSET = 2.7
PRIOR = 1000.0
ROUNDS = 2
HOT = 100_000
LONGEST_HOT = 256  # bytes
MAX_COUNTED = 200_000  # distinct words a task gathers before it hands them on
END = b" "  # no word holds a space
_UNIT = 1 << 16
_LN10 = math.log(10.0)
_SUMS = ["n_tokens", "n_known", "base_score", "score"]
_SPACE = "▁"
_NONE = -math.inf
_WALKERS: dict[str, object] = {}


class Weights(NamedTuple):
    """Pieces as the bytes they spell, and the natural logarithms of their probabilities and that of the end."""

    name: str
    spelled: list[bytes]
    logs: list[float]
    end: float


def _named(spelled: list[bytes], shares: np.ndarray) -> Weights:
    """``shares`` of the pieces and, last, of the end, as weights."""
    logs = np.log(shares / shares.sum())
    return Weights(uuid.uuid4().hex, spelled, logs[:-1].tolist(), float(logs[-1]))


def vocabulary(path: str) -> Weights:
    """The pieces of a sentencepiece file with their first weights. Pieces that spell the same bytes are one."""
    import sentencepiece

    file = sentencepiece.SentencePieceProcessor(model_file=path)
    real = [i for i in range(file.get_piece_size()) if not (file.is_control(i) or file.is_unknown(i) or file.is_unused(i))]
    texts = sorted((i for i in real if not file.is_byte(i)), key=lambda i: (-file.get_score(i), i))
    merges = all(file.get_score(i).is_integer() for i in texts)  # ranks; logarithms are not whole numbers
    shares: dict[bytes, float] = {}
    for rank, i in enumerate(texts):
        spelled = file.id_to_piece(i).replace(_SPACE, " ").encode()
        shares[spelled] = shares.get(spelled, 0.0) + (1.0 / (OFFSET + rank) if merges else math.exp(file.get_score(i)))
    least = min(shares.values())
    for byte in range(256):
        shares[bytes([byte])] = shares.get(bytes([byte]), 0.0) + least
    return _named(list(shares), np.array([*shares.values(), least]))


def walker(weights: Weights):
    """The automaton that finds all pieces in a text, kept by the worker for the last weights it met."""
    if weights.name not in _WALKERS:
        import ahocorasick

        found = ahocorasick.Automaton()
        for i, (spelled, log) in enumerate(zip(weights.spelled, weights.logs)):
            found.add_word(spelled.decode("latin-1"), (len(spelled), log, i))
        found.make_automaton()
        _WALKERS.clear()
        _WALKERS[weights.name] = found
    return _WALKERS[weights.name]


def _forward(pieces, text: str, found=None) -> list[float]:
    """The logarithms of the probabilities of all openings of a text; ``found`` gets the pieces met, by ascending end."""
    exp, log1p = math.exp, math.log1p
    reached = [0.0] + [_NONE] * len(text)
    for last, piece in pieces.iter(text):
        end = last + 1
        new, old = reached[end - piece[0]] + piece[1], reached[end]
        if old < new:
            reached[end] = new + log1p(exp(old - new))  # exp(-inf) is 0
        elif old > _NONE:
            reached[end] = old + log1p(exp(new - old))
        if found is not None:
            found[0].append(end)
            found[1].append(piece)
    return reached


def marginal(pieces, word: bytes) -> float:
    """The natural logarithm of the probability of a word, with the space before it, over all its segmentations."""
    return _forward(pieces, " " + word.decode("latin-1"))[-1]


def expected_uses(pieces, word: bytes, times: int, uses: list[int]) -> None:
    """Add to ``uses`` how often each piece is expected in ``times`` such words, in units of 2^-16.

    From the end back, the share of segmentations that pass a place is dealt to the pieces that end there, by how much
    of the forward sum each brought.
    """
    exp, unit = math.exp, _UNIT
    text = " " + word.decode("latin-1")
    ends: list[int] = []
    met: list[tuple] = []
    reached = _forward(pieces, text, (ends, met))
    passing = [0.0] * len(text) + [1.0]
    for end, (length, log, i) in zip(reversed(ends), reversed(met)):
        there = passing[end]
        if there:
            start = end - length
            share = there * exp(reached[start] + log - reached[end])
            passing[start] += share
            uses[i] += times * int(share * unit + 0.5)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    learned: Counter = Counter()
    other: Counter = Counter()

    def rows() -> Iterator[pa.RecordBatch]:
        for counts, factor in ((learned, 1), (other, 0)):
            n = pa.array(counts.values(), pa.int64())
            c = n if factor else pa.array(np.zeros(len(n), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), c, n], ["word", "c", "n"])
            counts.clear()

    for batch in batches:
        for text, learns in zip(batch.column(0), batch.column(1).to_pylist()):
            words = text.as_py().lower().split()  # of bytes: A-Z only, and at exactly the six blanks
            words.append(END)
            (learned if learns else other).update(words)
            if len(learned) + len(other) > MAX_COUNTED:
                yield from rows()
    yield from rows()


def word_counts(docs: DataFrame, learns: Column, text: str = "text") -> DataFrame:
    """(word, c, n): how often each word, ``END`` among them, stands in the texts that teach, and in all."""
    texts = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"), learns.alias("learns"))
    counted = texts.mapInArrow(_count, "word binary, c bigint, n bigint")
    return counted.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def fit(words: DataFrame, start: Weights, rounds: int = ROUNDS) -> Weights:
    """Weights re-estimated on the counted words that teach. Only sums per piece of the vocabulary reach the driver."""
    spark = words.sparkSession
    taught = words.where("c > 0")
    ends = taught.where(F.col("word") == F.lit(END)).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    first = np.exp(np.array([*start.logs, start.end]))
    weights = start
    for _ in range(rounds if ends else 0):
        sent = spark.sparkContext.broadcast(weights)

        def expect(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            pieces, uses = walker(sent.value), [0] * len(sent.value.logs)
            for batch in batches:
                for word, times in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    expected_uses(pieces, word, times, uses)
            used = [i for i, n in enumerate(uses) if n]
            arrays = [pa.array(used, pa.int32()), pa.array([uses[i] for i in used], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["piece", "uses"])

        spelled = taught.where(F.col("word") != F.lit(END)).select("word", "c")
        sums = spelled.mapInArrow(expect, "piece int, uses bigint").groupBy("piece").agg(F.sum("uses").alias("uses"))
        uses = np.zeros(len(first))
        for row in sums.collect():  # at most one per piece of the vocabulary
            uses[row["piece"]] = row["uses"] / _UNIT
        uses[-1] = ends
        weights = _named(start.spelled, uses + PRIOR * first)
    return weights


def scored_words(words: DataFrame, weights: Weights) -> tuple[DataFrame, int]:
    """(word, c, n, base, score) with the log10 scores of one occurrence, and the number of tokens learned from."""
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    sent = words.sparkSession.sparkContext.broadcast(weights)
    places = float(total + distinct + 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, end = walker(sent.value), sent.value.end
        for batch in batches:
            c = batch.column(1).to_numpy()
            base = np.log10((c + 1) / places)
            spelled = batch.column(0).to_pylist()
            logs = [(end if w == END else marginal(pieces, w)) / _LN10 for w in spelled]
            arrays = [*batch.columns, pa.array(base), pa.array(logs, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, ["word", "c", "n", "base", "score"])

    table = words.select("word", "c", "n")
    return table.mapInArrow(score, "word binary, c bigint, n bigint, base double, score double"), total


def score_documents(docs: DataFrame, scored: DataFrame, keep: dict[str, Column], text: str = "text") -> DataFrame:
    """``keep`` (name -> column of ``docs``) and n_tokens, n_known, base_score and score of every row."""
    spark = docs.sparkSession
    common, _ = head(scored.where(F.length("word") <= LONGEST_HOT), "n", HOT)
    few = common.select("word", "c", "base", "score").toArrow()
    places = {word: i for i, word in enumerate(few["word"].to_pylist())}
    values = [(few["c"].to_numpy() > 0).astype(np.int64), few["base"].to_numpy(), few["score"].to_numpy()]
    sent = spark.sparkContext.broadcast((places, values))
    names = list(keep)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*[c.alias(n) for n, c in keep.items()]).alias("keep"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"),
    )

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, (known, bases, scores) = sent.value
        for batch in batches:
            out: list[tuple] = []
            for value in batch.column(2):
                counts = Counter(value.as_py().lower().split())
                n_tokens = counts.total() + 1
                counts[END] = 1
                place = np.fromiter(map(places.get, counts, itertools.repeat(-1)), np.int64, len(counts))
                times = np.fromiter(counts.values(), np.int64, len(counts))
                common = place >= 0
                at, n = place[common], times[common]
                words = list(counts)
                rest = [words[i] for i in np.flatnonzero(~common)]
                sums = int(n @ known[at]), float(n @ bases[at]), float(n @ scores[at])
                out.append((n_tokens, *sums, rest, times[~common]))
            cells = list(zip(*out)) if out else [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            arrays = [batch.column(0), batch.column(1), *[pa.array(c, k) for c, k in zip(cells, kinds)]]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "keep", *_SUMS, "rest", "times"])

    kind = rows.schema["keep"].dataType.simpleString()
    sums = "n_tokens bigint, n_known bigint, base_score double, score double"
    added = stored(
        rows.mapInArrow(add_up, f"row bigint, keep {kind}, {sums}, rest array<binary>, times array<bigint>")
    )
    seldom = added.select("row", F.explode(F.arrays_zip("rest", "times")).alias("w"))
    seldom = seldom.select("row", F.col("w.rest").alias("word"), F.col("w.times").alias("times")).join(scored, "word")
    later = seldom.select(
        "row",
        F.lit(None).cast(kind).alias("keep"),
        F.lit(0).cast("bigint").alias("n_tokens"),
        F.when(F.col("c") > 0, F.col("times")).otherwise(0).alias("n_known"),
        (F.col("times") * F.col("base")).alias("base_score"),
        (F.col("times") * F.col("score")).alias("score"),
    )
    both = added.select("row", "keep", *_SUMS).unionByName(later)
    whole = both.groupBy("row").agg(F.first("keep", ignorenulls=True).alias("keep"), *[F.sum(s).alias(s) for s in _SUMS])
    return whole.select(*[F.col(f"keep.`{n}`").alias(n) for n in names], *_SUMS)


def likelihoods(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``."""
    words = stored(word_counts(docs, ~held_out(F.col("doc_id"))))
    scored, total = scored_words(words, fit(words, vocabulary(path)))
    keep = {"doc_id": F.col("doc_id"), "held_out": held_out(F.col("doc_id"))}
    out = score_documents(docs, stored(scored), keep)
    train_tokens = F.lit(total).cast("bigint").alias("train_tokens")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", train_tokens, "base_score", "score")
