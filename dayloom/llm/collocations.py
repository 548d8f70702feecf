"""Phrases whose words stand together more often than by chance, by marginalising counts of the longest windows.

Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends, and pieces into words at space and tab. Each word
opens one window: it and the next four of its piece, as five lead columns, padded with '' behind the piece's end. Only
these longest windows are counted; Spark's ROLLUP over (lang, w1, .., w5) then sums them to the counts of all shorter phrases,
of single words, and of all words of a language.

Most windows are seen once, and a phrase below ``min_count`` is no part of any result, nor is a longer one that begins
with it. So a window is padded from where its opening words are rare beyond doubt: one pass first adds up all openings of two
to five words in a table of 2^``bits`` counters, by hash. Several openings may share a counter, which can only make it too
large; a counter below ``min_count`` therefore proves that none of its openings has a count that matters. All counts
that are kept are exact whatever the size of the table; a small one only leaves more windows to the ROLLUP. So the table
grows with the texts (``table_bits``). No task holds it: openings are sent as sorted places, about a byte each, to where
their part of 262,144 counters is added up. Of a counter only whether it reached ``min_count`` is kept, and these bits, 2 MB to
128 MB, are the only thing broadcast.

A phrase of count a, cut after its first k words into parts of counts l and r, scores ``floor(1000 a n / (l r))`` in
decimals of 38 digits, n all words of its language; its lowest cut counts, the first of equals. A phrase whose words stand inside a
longer one of at least ``share`` percent of its count is dropped; for each language the ``top`` best remain.

No shuffle is by language alone: windows meet by all their words, phrases by their text, and the last ranking takes only each
task's own ``top`` per language.

Defined results: a null or empty text has no words; a null language is ``und``; repeated rows count as often as they
stand; ties in score go to the larger count, then to the phrase that comes first in UTF-8 byte order; an empty table gives no rows;
columns other than ``lang`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from dayloom.session import stored

ORDER = 5  # words of the longest window
MIN_COUNT = 100
SHARE = 100  # percent
TOP = 2000
BITS = 24  # of the smallest table
MOST_BITS = 30  # of the largest one, of which 128 MB are broadcast
PART = 1 << 18  # counters in a row of the table
RUN = 1 << 22  # openings that are sorted together
BLOCK = 400_000  # words that a task looks at together
SALTS = 64
JOINED = 32  # tasks that become one where only counters are gathered
_END = b"\xff"  # stands for the end of a piece; no byte of UTF-8
_TABLE = bytes(
    0xFF if b in b".,;:!?\n\x0b\x0c\r" else 0x20 if b == 0x09 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_WORDS = [f"w{i}" for i in range(1, ORDER + 1)]


class _Numbers(dict):
    """Numbers for words in the order they come; the end of a piece is 0."""

    def __init__(self) -> None:
        self[_END] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Block:
    """Words of several texts, their languages, and a hash of each."""

    def __init__(self, texts: list[tuple[str, list[bytes]]]) -> None:
        import xxhash

        numbers, langs = _Numbers(), {}
        self.words = np.concatenate([np.fromiter(map(numbers.__getitem__, w), np.int32, len(w)) for _, w in texts])
        codes = [langs.setdefault(lang, len(langs)) for lang, _ in texts]
        self.lang = np.repeat(np.array(codes, np.int32), [len(w) for _, w in texts])
        self.spelled, self.langs = list(numbers), list(langs)
        self._hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
        self._seeds = np.fromiter((xxhash.xxh64_intdigest(x.encode(), 1) for x in langs), np.uint64, len(langs))

    def openings(self, frequent=None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(k, places, hashes) of the openings of k words inside a piece, of those that ``frequent`` lets go on."""
        places = np.flatnonzero(self.words)
        hashes = (self._hashes[self.words[places]] ^ self._seeds[self.lang[places]]) * _ODD
        yield 1, places, hashes
        for k in range(2, ORDER + 1):
            following = self.words[places + (k - 1)]  # the last word of a block is an end
            inside = following != 0
            places = places[inside]
            hashes = (hashes[inside] ^ self._hashes[following[inside]]) * _ODD
            hashes ^= hashes >> np.uint64(29)
            if frequent is not None:
                kept = frequent(hashes)
                places, hashes = places[kept], hashes[kept]
            yield k, places, hashes


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    texts, n = [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = text.as_py().translate(_TABLE).replace(_END, b" \xff ").split()
            words.append(_END)
            texts.append((lang, words))
            n += len(words)
            if n >= BLOCK:
                block = _Block(texts)
                texts, n, words = [], 0, []  # let go before the block is worked on
                yield block
    if texts:
        yield _Block(texts)


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def table_bits(texts: DataFrame, min_count: int) -> int:
    """The bits of a table with at least four counters per ``min_count`` bytes of text, between ``BITS`` and ``MOST_BITS``.

    Words of one letter, the shortest, open two windows of two words and more per byte, so that a counter's mean is below half of
    ``min_count`` then; with common words it is about an eighth. The largest table does for 27 GB of text at a ``min_count`` of
    100, and has means below it up to some five times that.
    """
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(max((4 * size // max(min_count, 1)).bit_length(), BITS), MOST_BITS)


def _steps(places: np.ndarray, size: int, min_count: int) -> Iterator[tuple[int, bytes]]:
    """(part, steps) of places in parts of ``size``: the steps from one place to the next, in order, the first one from the part's start.

    A step is a byte; 255 means that it goes on with the next one. No place comes more than ``min_count`` times.
    """
    places.sort()
    if len(places) > min_count:
        places = places[np.append(np.ones(min_count, bool), places[min_count:] != places[:-min_count])]
    starts = np.flatnonzero(np.append(True, places[1:] // size != places[:-1] // size))
    steps = np.diff(places, prepend=places[:1])
    steps[starts] = places[starts] % size
    ends = np.cumsum(steps // 255 + 1, dtype=np.int64)
    sent = np.full(ends[-1], 255, np.uint8)
    sent[ends - 1] = steps % 255
    cuts = np.append(np.append(0, ends)[starts], ends[-1])
    for part, begin, end in zip(places[starts] // size, cuts, cuts[1:]):
        yield int(part), sent[begin:end].tobytes()


def _add_steps(counters: np.ndarray, steps: np.ndarray, min_count: int) -> None:
    """Add to the counters of a part what ``_steps`` made of it; they stop at ``min_count``."""
    places = np.cumsum(steps, dtype=np.int64)[steps != 255]
    last = np.flatnonzero(np.append(places[1:] != places[:-1], True))
    places, n = places[last], np.diff(last, prepend=-1)
    counters[places] = np.minimum(counters[places] + n, min_count)


def frequent_openings(texts: DataFrame, bits: int, min_count: int) -> np.ndarray:
    """The table as bits, eight to a byte: of the counters over all openings of two words and more, which reach ``min_count``.

    A task sends its openings in runs of about ``RUN``. Steps are short where runs are full, so tasks are joined before, to a few
    per core, but never more than ``JOINED`` into one, as there may be more cores later on. The bits are stored, so that the driver
    takes them file by file.
    """
    kind = np.min_scalar_type(min_count)
    size = min(PART, 1 << bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, n = [], 0
        for block in _blocks(batches):
            for k, _, hashes in block.openings():
                if k > 1:
                    run.append(_places(hashes, bits).astype(np.uint32))
                    n += len(hashes)
            if n >= RUN:
                yield from sent(run)
                run, n = [], 0
        if n:
            yield from sent(run)

    def sent(run: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        places = np.concatenate(run)
        run.clear()
        rows = list(_steps(places, size, min_count))
        for i in range(0, len(rows), 256):
            yield parts(rows[i : i + 256])

    def parts(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        arrays = [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["part", "counters"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, steps in zip(batch.column(0).to_pylist(), batch.column(1)):
                if part not in sums:
                    sums[part] = np.zeros(size, kind)
                _add_steps(sums[part], np.frombuffer(steps.as_buffer(), np.uint8), min_count)
        for part, total in sums.items():
            yield parts([(part, np.packbits(total >= min_count, bitorder="little").tobytes())])

    spark = texts.sparkSession
    schema = "part int, counters binary"
    few = max(4 * spark.sparkContext.defaultParallelism, -(-texts.rdd.getNumPartitions() // JOINED))
    added = stored(texts.coalesce(few).mapInArrow(count, schema).repartition("part").mapInArrow(add, schema))
    out = np.zeros((-(-(1 << bits) // size), -(-size // 8)), np.uint8)
    for row in added.toLocalIterator():
        out[row["part"]] = np.frombuffer(row["counters"], np.uint8)
    return out.reshape(-1)


def _is_set(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (table[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1


def _counted(block: _Block, frequent: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct windows of a block: language, words (0 for padding), and how often each stands."""
    windows = np.zeros((len(block.words), ORDER), np.int32)
    last = np.zeros(len(block.words), np.uint64)
    longer = np.zeros(len(block.words), bool)
    for k, places, hashes in block.openings(lambda h: _is_set(frequent, _places(h, bits))):
        windows[places, k - 1] = block.words[places + (k - 1)]
        if k > 1:
            last[places], longer[places] = hashes, True
    # windows of one word are counted by language and word, without hashes; ends of pieces open none
    alone = (block.words != 0) & ~longer
    codes = block.lang[alone].astype(np.int64) * len(block.spelled) + block.words[alone]
    codes, n_alone = np.unique(codes, return_counts=True)
    ones = np.zeros((len(codes), ORDER), np.int32)
    ones[:, 0] = codes % len(block.spelled)
    lang, windows, last = block.lang[longer], windows[longer], last[longer]
    _, first, which, n = np.unique(last, return_index=True, return_inverse=True, return_counts=True)
    same = first[which]
    if not (np.array_equal(windows, windows[same]) and np.array_equal(lang, lang[same])):
        rows = np.column_stack([lang, windows])  # two windows of one hash: compare the words
        _, first, n = np.unique(rows, axis=0, return_index=True, return_counts=True)
    langs = np.concatenate([(codes // len(block.spelled)).astype(np.int32), lang[first]])
    return langs, np.concatenate([ones, windows[first]]), np.concatenate([n_alone, n])


def longest_windows(texts: DataFrame, bits: int | None = None, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, w1, .., w5, n): the counted windows, padded from where they are rare beyond doubt.

    ``bits`` is the table's size; without it the texts are measured first.
    """
    if bits is None:
        bits = table_bits(texts, min_count)
    sent = texts.sparkSession.sparkContext.broadcast(frequent_openings(texts, bits, min_count))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = sent.value
        for block in _blocks(batches):
            lang, windows, n = _counted(block, frequent, bits)
            spelled = pa.array([b"", *block.spelled[1:]], pa.binary()).cast(pa.string())
            langs = pa.array(block.langs, pa.string())
            for at in range(0, len(n), 50_000):
                some = slice(at, at + 50_000)
                columns = [spelled.take(pa.array(windows[some, k])) for k in range(ORDER)]
                arrays = [langs.take(pa.array(lang[some])), *columns, pa.array(n[some], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["lang", *_WORDS, "n"])
            pa.default_memory_pool().release_unused()  # a worker shares its executor's memory

    schema = ", ".join(f"{c} string" for c in ["lang", *_WORDS]) + ", n bigint"
    counted = texts.mapInArrow(gather, schema)
    return counted.groupBy("lang", *_WORDS).agg(F.sum("n").alias("n"))


def phrase_counts(windows: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, k, phrase, f): phrases of k words counted ``min_count`` times or more; k = 0 counts all words of lang."""
    sums = windows.rollup("lang", *_WORDS).agg(F.sum("n").alias("f"), F.grouping_id().alias("summed"))
    k = F.lit(ORDER) - F.bit_count("summed")
    whole = F.coalesce(*[F.when(k == i, F.col(_WORDS[i - 1]) != "") for i in range(1, ORDER + 1)], k == 0)
    kept = sums.where(whole & ((k == 0) | (F.col("f") >= min_count)))
    return kept.select("lang", k.cast("int").alias("k"), F.concat_ws(" ", *_WORDS).alias("phrase"), "f")


def _part(first: str, n: str) -> Column:
    return F.expr(f"array_join(slice(words, {first}, {n}), ' ')")


#: exact: the products have 38 digits, where a, n < 10^17 and l, r < 10^19
SCORE = """(CAST(1000 AS DECIMAL(4, 0)) * CAST(a AS DECIMAL(17, 0)) * CAST(n AS DECIMAL(17, 0)))
           div (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))"""


def _scored(counts: DataFrame, candidates: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) by the lowest cut."""
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    totals = counts.where("k = 0").select("lang", F.col("f").alias("n"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    cuts = candidates.withColumn("salt", salt).join(totals, ["lang", "salt"]).withColumn("cut", F.explode(F.expr("sequence(1, k - 1)")))
    cuts = cuts.withColumns({"first": _part("1", "cut"), "rest": _part("cut + 1", "k - cut")}).drop("words")
    known = counts.where("k > 0")
    for part, count in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(part), F.col("f").alias(count)), ["lang", part])
    lowest = cuts.withColumn("score", F.expr(SCORE)).groupBy("lang", "phrase", "a", "n")
    best = lowest.agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def _inside(candidates: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the largest count of a longer candidate that the phrase stands in."""
    spans = "flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), i -> array_join(slice(words, i, m), ' '))))"
    subs = candidates.where("k > 2").select("lang", F.explode(F.expr(spans)).alias("phrase"), "a")
    return subs.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))


def collocations(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    share: int = SHARE,
    top: int = TOP,
    bits: int | None = None,
    lang: str = "lang",
    text: str = "text",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two to five words of each language."""
    texts = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"),
    )
    counts = stored(phrase_counts(longest_windows(texts, bits, min_count), min_count))
    candidates = counts.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    scored = _scored(counts, candidates).join(_inside(candidates), ["lang", "phrase"], "left")
    kept = scored.where(f"longer IS NULL OR 100 * longer < {share} * a")
    # Spark cuts each task's rows to the best before it sends them only up to this rank
    conf, limit = docs.sparkSession.conf, "spark.sql.optimizer.windowGroupLimitThreshold"
    conf.set(limit, max(top, int(conf.get(limit, "1000"))))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


COLLOCATIONS_SQL = rf"""
    WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
               FROM documents),
    piece AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
    place AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
    f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
          FROM place, range(1, {ORDER + 1}) AS t(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
    n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
    c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= {MIN_COUNT}),
    cut AS (SELECT c.lang, c.phrase, c.a, n.n, j, x.f AS l, y.f AS r,
                   (1000::HUGEINT * c.a * n.n) // (x.f::HUGEINT * y.f) AS score
            FROM c JOIN n USING (lang), range(1, {ORDER}) AS t(j), f AS x, f AS y
            WHERE j < c.k AND x.lang = c.lang AND x.phrase = array_to_string(c.w[:j], ' ')
              AND y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1:], ' ')),
    lowest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
    inside AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
               FROM c, range(2, {ORDER}) AS t(m), range(1, {ORDER}) AS s(i)
               WHERE m < k AND i + m - 1 <= k GROUP BY ALL),
    kept AS (SELECT lowest.* FROM lowest LEFT JOIN inside USING (lang, phrase)
             WHERE longer IS NULL OR 100 * longer < {SHARE} * a),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
    FROM ranked WHERE rank <= {TOP}"""
