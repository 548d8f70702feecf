"""Language ID by a bidirectional gated recurrent network over bytes (``byte_gru``).

The network is trained on the driver from a bounded sample: ``sample`` windows of labelled documents outside the held-out
fold, chosen by a hash of doc_id, each cut at a hashed place of its text. Every language has its part of the sample, by
its count over all rows, so a rare one is learned from a table of any size; of more than ``max_labels`` labels the most frequent ones are learned. Every byte of every text is then labelled on
the executors, and a document's prediction is the label with the largest mean probability over its bytes.

Labels, source and doc_id are no inputs of a prediction. A document is held out when crc32 of its doc_id as text leaves
0 modulo 5 (a null doc_id counts as held out).

Defined results: a null text or one without a letter is ``und`` with score 0, as is every text when there is no labelled
one to learn from; of labels with equal means the first in order of their names is predicted; equal texts get equal predictions; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from dayloom.llm.byte_gru import WINDOW, ByteGru
from dayloom.llm.sampling import smallest_marks_by
from dayloom.llm.token_ids import let_go

SAMPLE = 6000
MAX_LABELS = 500  # labels that are learned, the most frequent ones; bounds what the driver gathers
STEPS = 260
BATCH = 96
UNKNOWN = "und"
_BLOCK = 1 << 20


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5, F.lit(0)) == 0


def has_letter(text: str) -> bool:
    """Whether a text holds a letter: a character of Unicode's categories L, as ``\\p{L}``; digits and number signs are none."""
    return any(map(str.isalpha, text))


def fit(docs: DataFrame, sample: int = SAMPLE, steps: int = STEPS, max_labels: int = MAX_LABELS) -> ByteGru | None:
    """The network fitted to a bounded sample of ``docs(doc_id, text, lang)``; None without labelled rows."""
    labelled = docs.where(F.col("lang").isNotNull() & ~held_out())
    labelled = labelled.where(F.col("text").rlike(r"\p{L}"))
    by_label = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(max_labels)
    counts = {r["lang"]: r["n"] for r in by_label.collect()}
    mark = F.xxhash64("doc_id", F.lit("language"))
    place = 1 + F.pmod(F.xxhash64("doc_id"), F.greatest(F.length("text") - WINDOW, F.lit(1)))
    windows = labelled.select(F.substr("text", place.cast("int"), F.lit(WINDOW)).alias("w"), "lang", mark.alias("mark"))
    rows = smallest_marks_by(windows, "lang", counts, sample)
    if not rows:
        return None
    labels = sorted({r["lang"] for r in rows})
    number = {lang: i for i, lang in enumerate(labels)}
    cut = [r["w"].encode("utf-8", "ignore")[:WINDOW] for r in rows]
    x = np.frombuffer(b"".join(c.ljust(WINDOW, b"\0") for c in cut), np.uint8).reshape(-1, WINDOW)
    y = np.array([number[r["lang"]] for r in rows])
    model = ByteGru(labels)
    model.train(x, y, np.array([len(c) for c in cut]), steps, BATCH)
    return model


def predict_texts(model: ByteGru | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if model is None:
        return langs, scores
    known = [i for i, t in enumerate(texts) if t and has_letter(t)]

    def judge(rows: list[int], raw: list[bytes]) -> None:
        p = model.pooled(raw)
        for i, best, score in zip(rows, p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
            langs[i], scores[i] = model.labels[best], min(1.0, score)

    rows, raw, size = [], [], 0
    for i in known:
        one = texts[i].encode("utf-8", "replace")
        if rows and size + len(one) > _BLOCK:
            judge(rows, raw)
            rows, raw, size = [], [], 0
        rows.append(i)
        raw.append(one)
        size += len(one)
    if rows:
        judge(rows, raw)
    return langs, scores


def _predictions(batches: Iterator[pa.RecordBatch], model: ByteGru | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, scores = predict_texts(model, batch.column("text").to_pylist())
        others = [n for n in batch.schema.names if n != "text"]
        columns = [batch.column(n) for n in others]
        yield pa.record_batch([*columns, pa.array(langs), pa.array(scores, pa.float64())], names=[*others, "lang_pred", "score"])


def identify(docs: DataFrame, model: ByteGru | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(
        functools.partial(_predictions, model=model), "doc_id bigint, held_out boolean, lang_pred string, score double"
    )


def _known(batches: Iterator[pa.RecordBatch], model: ByteGru | None, least: float) -> Iterator[pa.RecordBatch]:
    let_go()  # of what an earlier job kept in this worker
    for batch in batches:
        langs, scores = predict_texts(model, batch.column("text").to_pylist())
        yield batch.filter(pa.array([lang != UNKNOWN and s >= least for lang, s in zip(langs, scores)], pa.bool_()))


def keep_known(docs: DataFrame, model: ByteGru | None, least: float = 0.5) -> DataFrame:
    """The rows whose language is known with a score of at least ``least``, all columns kept."""
    return docs.mapInArrow(functools.partial(_known, model=model, least=least), docs.schema)
