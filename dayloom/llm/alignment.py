"""Alignment of two tokenizers: groups of tokens that cover the same bytes, and how often ids are linked.

Each text, behind one space, is encoded by a byte-level BPE file (A, ``tokenizers``) and by a sentencepiece file with byte fallback
(B, which adds that space itself). Both cover the same bytes; the places where a token of either ends cut a text into groups, and
tokens whose bytes overlap are linked. An id pair's count is the number of documents that hold it linked.

Both tokenizers can be cut at a single space between two characters that are no blanks: neither has a token across it, so parts
between such spaces are encoded and aligned alone, each distinct one once per worker while it is kept (``MAX_KEPT``). A text of at most ``chunk`` bytes is joined from
its parts' groups at once. A longer one is cut at multiples of ``chunk`` bytes, wherever these fall, into ranges that are dealt to all
tasks, each with the text from the nearest such space before it to the nearest behind it; a multiple without one in the ranges beside it
is left out, since tokens cannot be told there without the whole stretch. A range's tokens, those that end in it, make a
fragment (see ``fragments``): an open prefix, whole groups, an open suffix. ``FAN`` neighbours at a time are joined by key until one fragment
of a text is left; only the open ends travel, the groups stay where they are. The digest of a text then reads its groups in order as a stream.

Counting: a text's distinct pairs are stored as a sorted run of differences. Pairs are counted per task, then by one shuffle. The
``HOT`` most frequent pairs are broadcast (17 MB at most); the links of others and those of long texts meet their count by a
shuffle, in which a pair comes once per text.

Defined results: a text that is null or empty, or whose bytes one of the tokenizers does not give back (as for U+2581, which
B takes for a space), has no tokens, zeros, and an empty digest, and counts for no pair. Repeated rows are documents of their own. Special tokens'
strings are ordinary text. Ties for an id's highest count are all best. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from dayloom.llm.fragments import NOTHING, PAIR, Closed, Fragment, Open, Tokens, fragment, group, joined
from dayloom.llm.heads import head
from dayloom.session import stored

CHUNK = 1 << 16
FAN = 16
HOT = 1_000_000
MAX_KEPT = 500_000  # parts
LONGEST_KEPT = 32  # characters
CHARACTERS = 2_000_000  # that a task looks at together
MAX_COUNTED = 4_000_000  # links
_BLANKS = r"\s\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff"
_CUT = re.compile(f" (?<=[^{_BLANKS}] )(?=[^{_BLANKS}])")
_BLANK = re.compile(f"[{_BLANKS}]")
_SUMS = ["n_a", "n_b", "n_groups", "n_links"]
_ENDS = ["pre_a", "pre_a_ends", "pre_b", "pre_b_ends", "suf_a", "suf_a_ends", "suf_b", "suf_b_ends"]
_ENDS_SCHEMA = ", ".join(f"{c} array<{'bigint' if c.endswith('ends') else 'int'}>" for c in _ENDS)
_ALIGNERS: dict[tuple[str, str], Aligner] = {}

Part = tuple[int, int, int, int, bytes, bytes]  # as Closed, the pairs packed


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: those that print are themselves, others follow 256."""
    printing = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(printing)]
    return {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Both tokenizers, and the parts aligned lately."""

    def __init__(self, a: str, b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(a)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=b)
        byte_of = _byte_of()
        with open(a, encoding="utf-8") as file:
            entries = json.load(file)["model"]["vocab"]
        self._bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self._bytes_a[i] = bytes(map(byte_of.__getitem__, entry))
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self._bytes_b = [
            bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self._sizes_a, self._sizes_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self._bytes_a, self._bytes_b))
        # how a token is written where others of its group follow, and as the last of them
        self._written = [f"{i}{end}".encode() for i in range(len(self._bytes_a)) for end in ",|"]
        self._written += [f"{i}{end}".encode() for i in range(len(pieces)) for end in ",;"]
        self._written_sizes = np.fromiter(map(len, self._written), np.int64, len(self._written))
        self.kept: dict[str, Part | None] = {}

    def _encoded(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        encode = getattr(self._a, "encode_batch_fast", self._a.encode_batch)
        of_a = [e.ids for e in encode([" " + p for p in parts], add_special_tokens=False)]
        return of_a, self._b.encode(parts, num_threads=1) if parts else []

    def tokens(self, parts: list[str], starts: list[int]) -> Iterator[tuple[Tokens, Tokens] | None]:
        """The tokens of parts, with the space before them, that begin at the given bytes; None where bytes are lost."""
        for part, start, a, b in zip(parts, starts, *self._encoded(parts)):
            spelled_a, spelled_b = [self._bytes_a[i] for i in a], [self._bytes_b[i] for i in b]
            if b"".join(spelled_a) == b"".join(spelled_b) == (" " + part).encode():
                yield _ended(a, spelled_a, start), _ended(b, spelled_b, start)
            else:
                yield None

    def learn(self, parts: set[str]) -> list[str]:
        """Align the parts that are not known yet, and return them. They are known until ``forget``."""
        new = sorted(parts.difference(self.kept))
        if new:
            of_a, of_b = self._encoded(new)
            raw = [(" " + p).encode() for p in new]
            spell_a, spell_b = self._bytes_a.__getitem__, self._bytes_b.__getitem__
            whole = [
                b"".join(map(spell_a, a)) == r == b"".join(map(spell_b, b)) for a, b, r in zip(of_a, of_b, raw)
            ]
            fine = [i for i, w in enumerate(whole) if w]
            self.kept.update((p, None) for p, w in zip(new, whole) if not w)
            if fine:
                found = self._align([of_a[i] for i in fine], [of_b[i] for i in fine], [len(raw[i]) for i in fine])
                self.kept.update(zip([new[i] for i in fine], found))
        return new

    def _align(self, of_a: list[list[int]], of_b: list[list[int]], sizes: list[int]) -> Iterator[Part]:
        """The groups of parts, laid one behind the other so that all are cut at once.

        Between two neighbouring ends of either sequence lies the overlap of just two tokens: a link.
        """
        a, b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (of_a, of_b))
        ends_a, ends_b = np.cumsum(self._sizes_a[a]), np.cumsum(self._sizes_b[b])
        stops = np.cumsum(sizes)
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        every = np.union1d(ends_a, ends_b)
        pairs = a[np.searchsorted(ends_a, every)] << PAIR | b[np.searchsorted(ends_b, every)]
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        # written in order of groups, in each of them first the tokens of a
        order = np.empty(len(a) + len(b), np.int64)
        at_a = np.arange(len(a)) + np.searchsorted(group_b, group_a)
        at_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")
        order[at_a] = 2 * a + (cuts[group_a] == ends_a)
        order[at_b] = 2 * (len(self._bytes_a) + b) + (cuts[group_b] == ends_b)
        body = b"".join(map(self._written.__getitem__, order.tolist()))
        written = np.cumsum(self._written_sizes[order])
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (of_a, of_b))
        last_written = written[np.cumsum(n_a + n_b) - 1].tolist()
        last_link = np.searchsorted(every, stops, "right").tolist()
        last_group = np.searchsorted(cuts, stops, "right").tolist()
        packed = pairs.tobytes()
        begin = link = group = 0
        for i, (x, y) in enumerate(zip(n_a.tolist(), n_b.tolist())):
            yield x, y, last_group[i] - group, last_link[i] - link, body[begin : last_written[i] - 1], packed[8 * link : 8 * last_link[i]]
            begin, link, group = last_written[i], last_link[i], last_group[i]

    def forget(self, new: list[str]) -> None:
        full = len(self.kept) > MAX_KEPT
        for part in new:
            if full or len(part) > LONGEST_KEPT:
                del self.kept[part]


def _ended(ids: list[int], spelled: list[bytes], start: int) -> Tokens:
    out = []
    for i, piece in zip(ids, spelled):
        start += len(piece)
        out.append((i, start))
    return out


def _packed(groups: list[Closed]) -> Part:
    pairs = np.array([p for g in groups for p in g.pairs], np.int64).tobytes()
    n_a, n_b = sum(g.n_a for g in groups), sum(g.n_b for g in groups)
    return n_a, n_b, len(groups), sum(g.n_links for g in groups), b";".join([g.body for g in groups]), pairs


def aligner(a: str, b: str) -> Aligner:
    if (a, b) not in _ALIGNERS:
        _ALIGNERS[a, b] = Aligner(a, b)
    return _ALIGNERS[a, b]


# --- ranges of long texts ------------------------------------------------------------------------------------


def _can_cut(data: bytes, at: int) -> bool:
    before = data[max(0, at - 4) : at].decode("utf-8", "ignore")[-1:]
    behind = data[at + 1 : at + 5].decode("utf-8", "ignore")[:1]
    return bool(before and behind) and not (_BLANK.match(before) or _BLANK.match(behind))


def _cut_from(data: bytes, at: int, step: int, end: int) -> int:
    """The nearest place to cut at or before (``step`` -1) or behind ``at``, up to ``end``; -1 where there is none."""
    while True:
        at = data.rfind(b" ", end, at + 1) if step < 0 else data.find(b" ", at, end)
        if at < 0 or _can_cut(data, at):
            return at
        at += step


def ranges(text: str, chunk: int) -> Iterator[tuple[int, int, int, str]]:
    """(low, high, start, stretch): ranges of the bytes of the text behind a space, and the text around each to encode."""
    data = (" " + text).encode()
    edges = [(0, 0, 0)]  # a range's edge, and where to cut before and behind it
    for at in range(chunk, len(data), chunk):
        before, behind = _cut_from(data, at, -1, max(1, at - chunk)), _cut_from(data, at, 1, min(len(data), at + chunk))
        if before > edges[-1][2] and behind > 0:
            edges.append((at, before, behind))
    edges.append((len(data), len(data), len(data)))
    for (low, start, _), (high, _, end) in zip(edges, edges[1:]):
        yield low, high, start, data[start:end].decode()


def range_fragment(found: Aligner, low: int, high: int, start: int, stretch: str) -> Fragment | None:
    """The fragment of the tokens that end behind ``low`` and not behind ``high``; None where a tokenizer loses bytes."""
    parts = _CUT.split(stretch[1:])
    new = found.learn(set(parts))
    out = NOTHING
    for part in parts:
        end = start + 1 + len(part.encode())
        summary = found.kept[part]
        if summary is None:
            out = None
            break
        if start >= low and end <= high and out.cut and not out.suffix.a and not out.suffix.b:
            out.closed.append(Closed(*summary[:5], np.frombuffer(summary[5], np.int64).tolist()))
        else:
            ((a, b),) = found.tokens([part], [start])
            out = joined(out, fragment([t for t in a if low < t[1] <= high], [t for t in b if low < t[1] <= high]))
        start = end
    found.forget(new)
    return out


# --- whole texts and ranges, one pass ------------------------------------------------------------------------


def pack_links(pairs: np.ndarray) -> tuple[bytes, bytes]:
    """Distinct pairs in order as differences, and their numbers, each as planes of bytes, which compress well."""
    distinct, times = np.unique(pairs, return_counts=True)
    differences = np.diff(distinct, prepend=np.int64(0)).astype("<i8")
    return _planes(differences), _planes(times.astype("<i4"))


def _planes(values: np.ndarray) -> bytes:
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def unpack_links(differences: bytes, times: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(_values(differences, "<i8")), _values(times, "<i4").astype(np.int64)


def _values(planes: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def _aligned_rows(found: Aligner, rows: list[tuple], groups: bool) -> Iterator[tuple]:
    cut = [(row, keep, _CUT.split(text) if text else []) for row, keep, text in rows]
    new = found.learn({p for _, _, parts in cut for p in parts})
    for row, keep, parts in cut:
        got = [found.kept[p] for p in parts]
        if not got or None in got:
            yield row, keep, None, None, None, None, None, 0, 0, 0, 0, "", *pack_links(np.empty(0, np.int64)), b"" if groups else None
            continue
        n_a, n_b, n_groups, n_links, bodies, pairs = zip(*got)
        body = b";".join(bodies)
        yield (
            row, keep, None, None, None, None, None, sum(n_a), sum(n_b), sum(n_groups), sum(n_links),
            hashlib.sha256(body).hexdigest(), *pack_links(np.frombuffer(b"".join(pairs), np.int64)), body if groups else None,
        )
    found.forget(new)


def _first_pass(a: str, b: str, chunk: int, groups: bool) -> Callable:
    """Rows of whole texts, aligned, and of the ranges of long ones, to align."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = aligner(a, b)
        for batch in batches:
            keeps = batch.schema.field("keep").type
            rows, characters, out = [], 0, []
            for row, keep, text in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                text = text.as_py()
                if text and len(text) >= chunk // 4 and len(text.encode()) > chunk:
                    for seq, (low, high, start, stretch) in enumerate(ranges(text, chunk)):
                        out.append((row, keep, seq, low, high, start, stretch, *[None] * 8))
                        if len(out) >= 64:
                            yield _batch(out, keeps)
                            out = []
                    continue
                rows.append((row, keep, text))
                characters += len(text or "")
                if characters >= CHARACTERS:
                    yield _batch(list(_aligned_rows(found, rows, groups)), keeps)
                    rows, characters = [], 0
            if rows or out:
                yield _batch([*out, *_aligned_rows(found, rows, groups)], keeps)

    return run


_NAMES = ["row", "keep", "seq", "low", "high", "start", "stretch", *_SUMS, "digest", "differences", "times", "groups"]
_KINDS = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4, pa.string(), *[pa.binary()] * 3]


def _batch(rows: list[tuple], keeps: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows))
    arrays = [pa.array(columns[0], pa.int64()), pa.array([k.as_py() for k in columns[1]], keeps)]
    arrays += [pa.array(c, k) for c, k in zip(columns[2:], _KINDS)]
    return pa.RecordBatch.from_arrays(arrays, _NAMES)


# --- fragments of long texts ---------------------------------------------------------------------------------


def _tokens_out(x: Open) -> list[list[int]]:
    return [[t[0] for t in x.a], [t[1] for t in x.a], [t[0] for t in x.b], [t[1] for t in x.b]]


def _tokens_in(ids_a, ends_a, ids_b, ends_b) -> Open:
    return Open(list(zip(ids_a, ends_a)), list(zip(ids_b, ends_b)))


_PIECE = "row bigint, seq int, place int, body binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, pairs array<bigint>, numbers array<bigint>"


def _piece(row: int, seq: int, place: int, groups: list[Closed]) -> list:
    n_a, n_b, n_groups, n_links, body, packed = _packed(groups)
    n_groups = sum(g.n_groups for g in groups)
    pairs, numbers = np.unique(np.frombuffer(packed, np.int64), return_counts=True)
    return [row, seq, place, body, n_a, n_b, n_groups, n_links, pairs.tolist(), numbers.tolist()]


def _to_batches(rows: Iterator[list], kinds: list[pa.DataType], names: list[str], size: int = 64) -> Iterator[pa.RecordBatch]:
    some: list[list] = []
    for row in rows:
        some.append(row)
        if len(some) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds)], names)
            some = []
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds)], names)


_PIECE_NAMES = ["row", "seq", "place", "body", *_SUMS, "pairs", "numbers"]
_PIECE_KINDS = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), *[pa.int64()] * 4, *[pa.list_(pa.int64())] * 2]
_END_KINDS = [pa.list_(pa.int64() if c.endswith("ends") else pa.int32()) for c in _ENDS]


def range_fragments(chunks: DataFrame, a: str, b: str) -> DataFrame:
    """One fragment per range: its whole groups as a piece, its open ends, and whether all bytes came back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = aligner(a, b)

        def rows() -> Iterator[list]:
            for batch in batches:
                for row, seq, low, high, start, stretch in zip(*[c.to_pylist() for c in batch.columns]):
                    got = range_fragment(found, low, high, start, stretch)
                    x = got or NOTHING
                    ends = _tokens_out(x.prefix) + _tokens_out(x.suffix)
                    yield [*_piece(row, seq, 1, x.closed), got is not None, x.cut, *ends]

        names = [*_PIECE_NAMES, "whole", "cut", *_ENDS]
        return _to_batches(rows(), [*_PIECE_KINDS, pa.bool_(), pa.bool_(), *_END_KINDS], names)

    schema = f"{_PIECE}, whole boolean, cut boolean, {_ENDS_SCHEMA}"
    some = chunks.select("row", "seq", "low", "high", "start", "stretch").repartition("row", "seq")
    return some.mapInArrow(run, schema)


_ELEMENT = f"row bigint, at int, closes int, cut boolean, seam boolean, {_ENDS_SCHEMA}"
_ELEMENT_NAMES = ["row", "at", "closes", "cut", "seam", *_ENDS]
_ELEMENT_KINDS = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), *_END_KINDS]


def _join_neighbours(table):  # unannotated: Spark reads annotations as its own kinds of function
    """Neighbouring fragments' open ends joined into one, and the groups that closed between them.

    ``closes`` is the range that holds the first place where both sequences end, behind which the prefix is whole.
    """
    rows = sorted(zip(*[table.column(c).to_pylist() for c in _ELEMENT_NAMES]), key=lambda r: r[1])
    out, closes, seams = NOTHING, None, []
    for row, at, first, cut, _, *ends in rows:
        x = Fragment(_tokens_in(*ends[:4]), cut, [], _tokens_in(*ends[4:]))
        if out.cut and cut:
            seams.append((first, Open(out.suffix.a + x.prefix.a, out.suffix.b + x.prefix.b)))
        closes = first if closes is None else closes
        out = joined(out, x)._replace(closed=[])
    at = rows[0][1]
    found = [[row, at, closes, out.cut, False, *_tokens_out(out.prefix), *_tokens_out(out.suffix)]]
    found += [[row, at, first, True, True, *_tokens_out(tokens), [], [], [], []] for first, tokens in seams]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*found), _ELEMENT_KINDS)], names=_ELEMENT_NAMES)


def seams(fragments: DataFrame, fan: int) -> DataFrame:
    """The pieces that close between fragments of a text, by joining ``fan`` neighbours at a time."""
    level = fragments.select(
        "row", F.col("seq").alias("at"), F.when(F.col("cut"), F.col("seq")).alias("closes"), "cut", F.lit(False).alias("seam"), *_ENDS
    )
    most = (fragments.agg(F.max("seq")).first()[0] or 0) + 1
    closed = []
    while most > 1:
        above = level.withColumn("up", F.floor(F.col("at") / fan).cast("int"))
        both = stored(above.groupBy("row", "up").applyInArrow(_join_neighbours, _ELEMENT))
        closed.append(both.where("seam"))
        level = both.where("NOT seam").withColumn("at", F.floor(F.col("at") / fan).cast("int"))
        most = -(-most // fan)
    closed.append(level.where("closes IS NOT NULL"))  # the first group of a text is the prefix of all of it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[list]:
            for batch in batches:
                for row, closes, *ends in zip(*[c.to_pylist() for c in batch.columns]):
                    tokens = _tokens_in(*ends)
                    if tokens.a or tokens.b:
                        yield _piece(row, closes, 0, [group(tokens)])

        return _to_batches(rows(), _PIECE_KINDS, _PIECE_NAMES)

    found = closed[0]
    for more in closed[1:]:
        found = found.unionByName(more)
    return found.select("row", "closes", *_ENDS[:4]).mapInArrow(run, _PIECE)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each text from its pieces in order, a stream."""
    current, digest, empty = None, hashlib.sha256(), True
    for batch in batches:
        out = []
        for row, body in zip(batch.column(0).to_pylist(), batch.column(1)):
            if row != current:
                if current is not None:
                    out.append((current, digest.hexdigest()))
                current, digest, empty = row, hashlib.sha256(), True
            text = body.as_py()
            if text:
                digest.update(text if empty else b";" + text)
                empty = False
        if out:
            yield _digest_batch(out)
    if current is not None:
        yield _digest_batch([(current, digest.hexdigest())])


def _digest_batch(rows: list[tuple[int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])], ["row", "digest"])


def long_texts(chunks: DataFrame, a: str, b: str, fan: int) -> tuple[DataFrame, DataFrame]:
    """Of texts cut into ranges: (row, sums, digest) of those whose bytes came back, and all pieces of their groups."""
    fragments = stored(range_fragments(chunks, a, b))
    lost = fragments.where("NOT whole").select("row").distinct()
    fine = fragments.join(lost, "row", "left_anti")
    pieces = stored(fine.select(*_PIECE_NAMES).unionByName(seams(fine, fan)))
    ordered = pieces.select("row", "body", "seq", "place").repartition("row").sortWithinPartitions("row", "seq", "place")
    digests = ordered.select("row", "body").mapInArrow(_digests, "row bigint, digest string")
    sums = pieces.groupBy("row").agg(*[F.sum(s).alias(s) for s in _SUMS])
    return sums.join(digests, "row"), pieces


# --- counts of pairs -----------------------------------------------------------------------------------------


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pairs, n, waiting, size = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate([pairs, *waiting])
        distinct, which = np.unique(every, return_inverse=True)
        ones = np.ones(size, np.int64)
        return distinct, np.bincount(which, np.concatenate([n, ones]), len(distinct)).astype(np.int64)

    def rows() -> Iterator[pa.RecordBatch]:
        for at in range(0, len(pairs), 100_000):
            some = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[some]), pa.array(n[some])], ["pair", "n"])

    for batch in batches:
        for differences, times in zip(batch.column(0), batch.column(1)):
            waiting.append(unpack_links(differences.as_py(), times.as_py())[0])
            size += len(waiting[-1])
            if size >= MAX_COUNTED:
                pairs, n = merged()
                waiting, size = [], 0
                if len(pairs) >= MAX_COUNTED:
                    yield from rows()
                    pairs, n = pairs[:0], n[:0]
    pairs, n = merged()
    yield from rows()


def pair_counts(links: DataFrame, loose: DataFrame) -> DataFrame:
    """(pair, n, best): in how many documents ids are linked, and whether that is the most for the first of them."""
    each = links.select("differences", "times").mapInArrow(_count_pairs, "pair bigint, n bigint")
    each = each.unionByName(loose.groupBy("pair").agg(F.count(F.lit(1)).alias("n")))
    counts = stored(each.groupBy("pair").agg(F.sum("n").alias("n")))
    first = F.shiftright("pair", PAIR).alias("a")
    most = counts.groupBy(first).agg(F.max("n").alias("most"))
    return counts.withColumn("a", first).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _sum_links(table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Callable:
    """n_best and count_sum over the pairs of the table, and the other pairs of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = table.value
        for batch in batches:
            out = []
            for differences, times in zip(batch.column(1), batch.column(2)):
                mine, n = unpack_links(differences.as_py(), times.as_py())
                at = np.minimum(np.searchsorted(pairs, mine), max(len(pairs) - 1, 0))
                known = pairs[at] == mine if len(pairs) else np.zeros(len(mine), bool)
                here, m = at[known], n[known]
                out.append((int(m[best[here]].sum()), int((m * counts[here]).sum()), mine[~known], n[~known]))
            n_best, sums, rest, numbers = zip(*out) if out else ((), (), (), ())
            longs = pa.list_(pa.int64())
            arrays = [batch.column(0), pa.array(n_best, pa.int64()), pa.array(sums, pa.int64())]
            arrays += [pa.array(rest, longs), pa.array(numbers, longs)]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "n_best", "count_sum", "pairs", "numbers"])

    return run


def _exploded(rows: DataFrame) -> DataFrame:
    each = rows.select("row", F.explode(F.arrays_zip("pairs", "numbers")).alias("x"))
    return each.select("row", F.col("x.pairs").alias("pair"), F.col("x.numbers").alias("number"))


def align(
    docs: DataFrame,
    a: str,
    b: str,
    keep: dict[str, Column],
    text: str = "text",
    chunk: int = CHUNK,
    fan: int = FAN,
    groups: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``keep`` (name -> column of ``docs``) and the sums and digest of every row; the counts of pairs; pieces of long texts.

    With ``groups`` the first frame also holds the groups as text, but for texts longer than ``chunk``: theirs are the
    ``body`` of the pieces (by ``row``, in the order of ``seq`` and ``place``).
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*[c.alias(n) for n, c in keep.items()]).alias("keep"),
        F.col(f"`{text}`").alias("text"),
    )
    kind = rows.schema["keep"].dataType.simpleString()
    schema = f"row bigint, keep {kind}, seq int, low bigint, high bigint, start bigint, stretch string, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, digest string, differences binary, times binary, groups binary"
    first = stored(rows.mapInArrow(_first_pass(a, b, chunk, groups), schema))
    short, chunks = first.where("seq IS NULL"), first.where("seq IS NOT NULL")
    long, pieces = long_texts(chunks, a, b, fan)
    loose = _exploded(pieces).groupBy("row", "pair").agg(F.sum("number").alias("number"))

    counts = stored(pair_counts(short, loose))
    few = head(counts, "n", HOT)[0].toArrow()
    order = np.argsort(few["pair"].to_numpy())
    table = tuple(few[c].to_numpy()[order] for c in ("pair", "n", "best"))
    sent = spark.sparkContext.broadcast(table)
    known = stored(
        short.select("row", "differences", "times").mapInArrow(
            _sum_links(sent), "row bigint, n_best bigint, count_sum bigint, pairs array<bigint>, numbers array<bigint>"
        )
    )
    rest = _exploded(known).unionByName(loose).join(counts, "pair")
    later = rest.select(
        "row",
        F.when(F.col("best"), F.col("number")).otherwise(0).alias("n_best"),
        (F.col("number") * F.col("n")).alias("count_sum"),
    )
    nothing = [F.lit(None).cast("bigint").alias(c) for c in ("n_best", "count_sum")]
    no_row = [F.lit(None).cast(t).alias(c) for c, t in [("keep", kind), *[(s, "bigint") for s in _SUMS], ("digest", "string"), ("groups", "binary")]]
    about = ["keep", *_SUMS, "digest", "groups"]
    ends = chunks.where("seq = 0").select("row", "keep").join(long, "row", "left").withColumn("groups", F.lit(None).cast("binary"))
    texts = short.select("row", *about).unionByName(ends.select("row", *about)).select("row", *about, *nothing)
    links = known.select("row", "n_best", "count_sum").unionByName(later).select("row", *no_row, "n_best", "count_sum")
    every = texts.unionByName(links).groupBy("row").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("keep", "digest", "groups")],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (*_SUMS, "n_best", "count_sum")],
    )
    out = every.select(
        "row", *[F.col(f"keep.`{n}`").alias(n) for n in keep], *_SUMS, "n_best", "count_sum",
        F.coalesce("digest", F.lit("")).alias("groups_sha256"), *(["groups"] if groups else []),
    )
    return out, counts, pieces


def alignments(docs: DataFrame, a: str, b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``."""
    found, _, _ = align(docs, a, b, {"doc_id": F.col("doc_id")})
    return found.drop("row")
