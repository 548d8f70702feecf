"""N-gram Jaccard join by a token-group matrix: documents linked when their shingle sets have J >= threshold.

The join is exact (up to equal 64-bit hashes of different shingles) and goes as follows.

1. *Sets.* One pass over the texts gives each document its set of shingle hashes, of which only a key, the size and a
   1024-bit parity signature are kept. Equal sets become one node, so exact copies cost one row each. The same pass
   counts shingles that come more than once within a task, in bounded memory.
2. *Order.* The shingles most counted over all documents, at most ``N_COMMON``, come last in the global order; the rest
   is ordered by hash. Any order gives the same links; this one keeps common passages out of the prefixes.
3. *Prefixes.* Two sets of J >= t share at least l tokens among the first n - ceil(t n) + l of each. A second pass emits
   only those prefix tokens. They are shuffled by token, sorted, and tokens of a single set are dropped as they stream
   by.
4. *Groups.* In each posting a set is compared with the smallest one and with the one before it: two rows per set and
   not all pairs. The components of the links found are the groups: documents that are similar to one another.
5. *Matrix.* Row (token, group) says that a member of the group has the token in its prefix: the group's token union.
   For a set and another group the count of shared tokens bounds from above what it shares with any one member, so only
   groups that reach l are opened. Members of an opened group are compared by size and by signature: in each bucket of
   odd difference at least one token differs, so more odd buckets than (1 - t) / (1 + t) (n1 + n2) rule a pair out.
   Large groups are compared in blocks, of which only the pairs that remain become rows; and so are the sets of a token
   of many groups, which leaves the matrix.
6. *Check.* Pairs that are left are computed in full from both texts. A link between two members of one group is not
   looked for again, as it can change no component.

Defined results: a null, empty or blank text has ``n_shingles`` 0 and is linked with nothing; equal rows are copies of
one another; rows with a null doc_id take part and have the component of their copies and links; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from dayloom.llm.components import components
from dayloom.llm.shingles import Shingler, mixed
from dayloom.llm.token_ids import let_go
from dayloom.session import stored

N_COMMON = 1 << 17  # shingles ordered last; fixes the size of what is sent to each executor
COMMON_LEAST = 12  # documents, as counted, from which a shingle can be one of them
_COUNTED = 2 << 20  # hashes a task gathers before it counts them
_KEPT = 1 << 17  # shingles whose counts a task keeps
_LANES = 16  # 64-bit words of a signature
SHARED = 3  # l: prefix tokens that linked sets share at least, where they are long enough
SMALL = 16  # members of a group that are compared by a join; larger ones block by block
HOT = 128  # groups of a token from which on its sets are compared block by block
BLOCK = 2048
FEW = 500_000  # rows of three numbers that may be broadcast, 20 MB
PERCENT = 75


def _needed(n: np.ndarray | int) -> np.ndarray | int:
    """ceil(t n): what a set of n shares at least with a set it is linked to."""
    return -(-PERCENT * n // 100)


class _Counter:
    """Counts of shingles that repeat in what one task reads, in bounded memory."""

    def __init__(self) -> None:
        self.buffer: list[np.ndarray] = []
        self.size = 0
        self.tokens, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def add(self, tokens: np.ndarray) -> None:
        self.buffer.append(tokens)
        self.size += len(tokens)
        if self.size >= _COUNTED:
            self.merge()

    def merge(self) -> None:
        tokens, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *self.buffer]), return_counts=True)
        self.buffer, self.size = [], 0
        tokens, counts = tokens[counts > 1], counts[counts > 1]
        both = np.concatenate((self.tokens, tokens))
        self.tokens, at = np.unique(both, return_inverse=True)
        self.counts = np.bincount(at, np.concatenate((self.counts, counts)), len(self.tokens)).astype(np.int64)
        if len(self.tokens) > _KEPT:
            top = np.argpartition(self.counts, -_KEPT)[-_KEPT:]
            self.tokens, self.counts = self.tokens[top], self.counts[top]


def _texts(column: pa.Array) -> Iterator[str | None]:
    """The texts of a column, few of them as Python strings at a time."""
    for at in range(0, len(column), 256):
        yield from column.slice(at, 256).to_pylist()


def _signature(tokens: np.ndarray) -> bytes:
    odd = np.bincount((tokens & np.uint64(64 * _LANES - 1)).astype(np.int64), minlength=64 * _LANES) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


class Naming(NamedTuple):
    """How sets are named: by ``bits`` of a hash; where two sets have one name, by that and a second hash.

    ``clashes`` are the names that several sets had, round by round. Both hashes together have 128 bits.
    """

    bits: int = 64
    clashes: tuple[frozenset[int], ...] = ()

    def keys(self, tokens: np.ndarray) -> tuple[int, int]:
        """The name of a set and its second hash."""
        both = tokens.sum(dtype=np.uint64), mixed(tokens + np.uint64(1)).sum(dtype=np.uint64)
        name, check = np.array(both, np.uint64).view(np.int64).tolist()
        if self.bits < 64:
            name &= (1 << self.bits) - 1
        for i, clashing in enumerate(self.clashes):
            if name in clashing:
                name ^= _turned(check, i + 1)
        return name, check

    def renamed(self, name: Column, check: Column) -> Column:
        """The same for the columns of the first names and second hashes."""
        for i, clashing in enumerate(self.clashes):
            turned = F.shiftleft(check, i + 1).bitwiseOR(F.shiftrightunsigned(check, 63 - i))
            name = F.when(name.isin(*clashing), name.bitwiseXOR(turned)).otherwise(name)
        return name


def _turned(value: int, by: int) -> int:
    """The 64 bits of a long turned left, as a signed long."""
    bits = value & ((1 << 64) - 1)
    bits = (bits << by | bits >> (64 - by)) & ((1 << 64) - 1)
    return bits - (1 << 64) if bits >> 63 else bits


_SET_SCHEMA = "doc_id bigint, text_id bigint, set_id bigint, check_id bigint, n bigint, signature binary, token bigint, times bigint"


def shingle_sets(docs: DataFrame, seed: int, naming: Naming = Naming()) -> DataFrame:
    """A row per document, and rows (token, times) of repeated shingles with a null ``n``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()  # of what an earlier job kept in this worker
        shingler, counter = Shingler(seed), _Counter()
        kinds = [pa.int64()] * 5 + [pa.binary()] + [pa.int64()] * 2
        names = ["doc_id", "text_id", "set_id", "check_id", "n", "signature", "token", "times"]
        for batch in batches:
            out = []
            for tokens in shingler.sets(_texts(batch.column(1))):
                counter.add(tokens)
                out.append((*naming.keys(tokens), len(tokens), _signature(tokens)))
            made = [pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 4, kinds[2:])]
            none = pa.nulls(len(out), pa.int64())
            yield pa.record_batch([batch.column(0), batch.column(2), *made, none, none], names=names)
        counter.merge()
        for a in range(0, len(counter.tokens), 1 << 16):
            tokens, times = counter.tokens[a : a + (1 << 16)].view(np.int64), counter.counts[a : a + (1 << 16)]
            empty = [pa.nulls(len(tokens), k) for k in kinds[:6]]
            yield pa.record_batch([*empty, pa.array(tokens), pa.array(times)], names=names)

    return docs.mapInArrow(rows, _SET_SCHEMA)


def common_tokens(sets: DataFrame) -> np.ndarray:
    """At most ``N_COMMON`` of the shingles most counted, the rarest first."""
    totals = sets.where("n IS NULL").groupBy("token").agg(F.sum("times").alias("times"))
    # eight steps to a doubling: a few hundred rows tell from which step on there are few enough
    totals = stored(totals.where(F.col("times") >= COMMON_LEAST).withColumn("step", F.floor(8 * F.log2("times")).cast("int")))
    least, room = 1 << 30, N_COMMON
    for row in totals.groupBy("step").count().orderBy(F.desc("step")).collect():
        room -= row["count"]
        if room < 0:
            break
        least = row["step"]
    top = totals.where(F.col("step") >= least).orderBy(F.desc("times"), "token")
    found = [r["token"] for r in top.select("token").collect()]
    return np.array(found[::-1], np.int64).view(np.uint64)


def prefix_tokens(docs: DataFrame, seed: int, common: np.ndarray, naming: Naming = Naming()) -> DataFrame:
    """(token, set_id): the first tokens of each set in the global order, once per set and task."""
    by_hash = np.argsort(common)
    sent = docs.sparkSession.sparkContext.broadcast((common[by_hash], by_hash))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        shingler = Shingler(seed)
        hashes, rank = sent.value
        done: set[int] = set()
        for batch in batches:
            found, owners, lengths = [], [], []
            for tokens in shingler.sets(_texts(batch.column(1))):
                n = len(tokens)
                owner = naming.keys(tokens)[0]
                if not n or owner in done:
                    continue
                if len(done) > 1 << 17:
                    done.clear()
                done.add(owner)
                length = n - _needed(n) + min(SHARED, _needed(n))
                if len(hashes):
                    at = np.minimum(np.searchsorted(hashes, tokens), len(hashes) - 1)
                    last = hashes[at] == tokens
                    if last.any():
                        late = tokens[last][np.argsort(rank[at[last]], kind="stable")]
                        tokens = np.concatenate((tokens[~last], late))
                found.append(tokens[:length])
                owners.append(owner)
                lengths.append(length)
            if found:
                token = np.concatenate(found).view(np.int64)
                owner = np.repeat(np.array(owners, np.int64), lengths)
                yield pa.record_batch([pa.array(token), pa.array(owner)], names=["token", "set_id"])

    return docs.mapInArrow(rows, "token bigint, set_id bigint")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop the tokens of a single set from rows sorted by (token, set_id)."""
    token = first = last = None  # of the posting that is open
    open_alone = False  # its first set is not written yet
    for batch in batches:
        t = batch.column(0).to_numpy(zero_copy_only=False)
        s = batch.column(1).to_numpy(zero_copy_only=False)
        fresh = np.ones(len(t), bool)
        fresh[1:] = (t[1:] != t[:-1]) | (s[1:] != s[:-1])
        if len(t) and token is not None:
            fresh[0] = t[0] != token or s[0] != last
        t, s = t[fresh], s[fresh]
        if not len(t):
            continue
        starts = np.flatnonzero(np.concatenate(([token is None or t[0] != token], t[1:] != t[:-1])))
        firsts = np.empty(len(t), np.int64)
        head = starts[0] if len(starts) else len(t)
        firsts[:head] = first if head else 0
        if len(starts):
            firsts[head:] = np.repeat(s[starts], np.diff(np.append(starts, len(t))))
        again = s != firsts  # not the first of its posting
        keep = again.copy()
        keep[:-1] |= again[1:]  # a first one followed by another of its posting
        previous = np.concatenate(([last or 0], s[:-1]))
        out = [t[keep], s[keep], firsts[keep], np.where(again, previous, s)[keep]]
        if head > 0 and open_alone:
            out = [np.concatenate(([x], c)) for x, c in zip((token, first, first, first), out)]
        token, first, last = int(t[-1]), int(firsts[-1]), int(s[-1])
        open_alone = not again[-1]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in out], names=["token", "set_id", "first", "previous"])


def postings(tokens: DataFrame) -> DataFrame:
    """(token, set_id, first, previous): the sets of every token that has two or more.

    ``first`` is the smallest of them, ``previous`` the next smaller one; both are the set itself for the first.
    """
    sorted_tokens = tokens.repartition("token").sortWithinPartitions("token", "set_id")
    return sorted_tokens.mapInArrow(_shared, "token bigint, set_id bigint, first bigint, previous bigint")


def _may_link(a: str, b: str) -> Column:
    """Sizes within the threshold, and not more odd buckets than linked sets can have."""
    lanes = range(_LANES)
    odd = " + ".join(f"bit_count({a}_s[{k}] ^ {b}_s[{k}])" for k in lanes)
    return F.expr(
        f"100 * least({a}_n, {b}_n) >= {PERCENT} * greatest({a}_n, {b}_n) AND "
        f"({odd}) * {100 + PERCENT} <= {100 - PERCENT} * ({a}_n + {b}_n)"
    )


def _lanes(signature: str) -> str:
    parts = ", ".join(f"CAST(conv(hex(substr({signature}, {8 * k + 1}, 8)), 16, -10) AS BIGINT)" for k in range(_LANES))
    return f"array({parts})"


def checked(pairs: DataFrame, texts: DataFrame, seed: int) -> DataFrame:
    """The pairs (a, b) of sets that are linked, computed from one text of each."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(seed)
        held: tuple[int | None, np.ndarray] = (None, np.empty(0, np.uint64))
        for batch in batches:
            a, b = (c.to_pylist() for c in batch.columns[:2])
            keep = []
            for i, other in enumerate(shingler.sets(_texts(batch.column(3)))):
                if held[0] != a[i]:
                    held = (a[i], next(shingler.sets([batch.column(2)[i].as_py()])))
                shared = len(np.intersect1d(held[1], other, assume_unique=True))
                keep.append(100 * shared >= PERCENT * (len(held[1]) + len(other) - shared))
            kept = [pa.array([x for x, k in zip(c, keep) if k], pa.int64()) for c in (a, b)]
            yield pa.record_batch(kept, names=["a", "b"])

    with_a = pairs.join(texts.select(F.col("set_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = with_a.join(texts.select(F.col("set_id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(linked, "a bigint, b bigint")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_id"))


def similar_groups(docs: DataFrame, seed: int = 0, key_bits: int = 64) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs(doc_id, text)``."""
    return _grouped(_rows(docs), seed, key_bits).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_per_group(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The rows of ``docs`` without all but the first document of each group; rows equal in doc_id and text are one.

    Rows without shingles all stay. Only what goes is shuffled or broadcast, not the texts that stay.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.col("row.doc_id").cast("bigint").alias("id"), F.xxhash64("row.text").alias("text_id"))
    found = stored(_grouped(_rows(docs), seed).select("doc_id", "text_id", "root", "n"))
    place = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "text_id")
    first = found.where("n > 0").groupBy("root").agg(F.min(place).alias("first"))
    others = found.where("n > 0").join(first, "root").where(~place.eqNullSafe(F.col("first")))
    gone = others.select(F.col("doc_id").alias("g"), F.col("text_id").alias("t")).distinct()
    again = found.groupBy(F.col("doc_id").alias("g"), F.col("text_id").alias("t")).count().where("count > 1").select("g", "t")

    def matched(other: DataFrame) -> Column:
        return rows["id"].eqNullSafe(other["g"]) & (rows["text_id"] == other["t"])

    apart, twins = gone.union(again).distinct(), again.join(gone, ["g", "t"], "left_anti")
    stay = rows.join(apart, matched(apart), "left_anti")
    twice = rows.join(twins, matched(twins), "left_semi")
    return stay.union(twice.dropDuplicates(["id", "text_id"])).select("row.*")


def _grouped(rows: DataFrame, seed: int, key_bits: int = 64) -> DataFrame:
    """(doc_id, text_id, n, root, component_id) of ``rows(doc_id, text, text_id)``; a null root where n is 0."""
    naming = Naming(key_bits)
    sets = stored(shingle_sets(rows, seed, naming))
    # names that several sets have are few (none below about 10^9 sets); those sets are named anew until all differ
    while True:
        documents = sets.where("n IS NOT NULL").select(
            "doc_id", "text_id", naming.renamed(F.col("set_id"), F.col("check_id")).alias("set_id"), "check_id", "n", "signature"
        )
        nodes = stored(
            documents.where("n > 0").groupBy("set_id").agg(
                F.min("doc_id").alias("doc_id"), F.min(F.struct("doc_id", "text_id")).alias("row"), F.first("n").alias("n"), F.first("signature").alias("signature"),
                (F.min("check_id") == F.max("check_id")).alias("one"),
            ).withColumn("s", F.expr(_lanes("signature"))).drop("signature")
        )
        clashing = frozenset(r["set_id"] for r in nodes.where("NOT one").select("set_id").collect())
        if not clashing:
            break
        naming = naming._replace(clashes=(*naming.clashes, clashing))
    matrix = stored(postings(prefix_tokens(rows, seed, common_tokens(sets), naming)))
    a = nodes.select(F.col("set_id").alias("a"), F.col("n").alias("a_n"), F.col("s").alias("a_s"))
    b = nodes.select(F.col("set_id").alias("b"), F.col("n").alias("b_n"), F.col("s").alias("b_s"))

    def compared(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The pairs (a, b) that size and signature allow, and those of them that are linked."""
        near = stored(pairs.join(a, "a").join(b, "b").where(_may_link("a", "b")).select("a", "b"))
        return near, stored(checked(near, _texts_of(rows, nodes, near), seed))

    others = matrix.where("set_id != first").select(F.explode(F.array("first", "previous")).alias("a"), F.col("set_id").alias("b"))
    near, links = compared(_ordered(others).distinct())
    member = _members(nodes, links)
    of_group = _several_groups(matrix.select("token", "set_id").join(member, "set_id"))
    # tokens of many groups are compared in blocks; pairs that share none of them are found by the matrix
    spread = of_group.groupBy("token").agg(F.count("*").alias("sets"), F.countDistinct("group").alias("groups"))
    hot = stored(spread.where(F.col("groups") > HOT))
    hot_pairs = _pairs_of_hot_tokens(of_group, hot, nodes)
    of_group = of_group.join(hot, "token", "left_anti")
    union = of_group.select("token", F.col("group").alias("other"), F.col("size").alias("other_size")).distinct()
    least_shared = F.least(F.lit(SHARED), F.ceil(F.col("n") * (PERCENT / 100) ** 2))
    # each two groups once: the sets of the smaller one against the larger one
    larger = "other_size > size OR other_size = size AND other < group"
    bounded = of_group.join(union, "token").where(larger).groupBy("set_id", "other", "other_size", "n").count()
    bounded = bounded.where(F.col("count") >= least_shared)
    bounded = stored(bounded.select(F.col("set_id").alias("b"), "other", F.col("other_size").alias("size")))
    members = member.select(F.col("group").alias("other"), F.col("set_id").alias("a"))
    opened = bounded.where(F.col("size") <= SMALL).join(members, "other").select("a", "b")
    opened = opened.join(a, "a").join(b, "b").where(_may_link("a", "b")).select("a", "b")
    blocks = _in_blocks(bounded.where(F.col("size") > SMALL), members, nodes)
    found = _ordered(opened.union(blocks).union(hot_pairs)).distinct()
    _, more = compared(found.join(near, ["a", "b"], "left_anti"))
    links = links.union(more)

    final = components(links)
    named = nodes.join(final.withColumnRenamed("node", "set_id"), "set_id", "left")
    named = named.select("set_id", "doc_id", F.coalesce("root", "set_id").alias("root"))
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_set = named.select("set_id", "root").join(smallest, "root").select("set_id", "root", "component_id")
    linked = documents.where("n > 0").join(by_set, "set_id")
    empty = documents.where("n = 0").select("*", F.lit(None).cast("bigint").alias("root"), F.col("doc_id").alias("component_id"))
    columns = ["doc_id", "text_id", "n", "root", "component_id"]
    return linked.select(*columns).union(empty.select(*columns))


def _members(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(set_id, n, group, size) of every set; size is that of its group."""
    grouped = components(links).withColumnRenamed("node", "set_id")
    sizes = grouped.groupBy(F.col("root").alias("group")).agg((F.count("*") + 1).alias("size"))
    member = nodes.select("set_id", "n").join(grouped, "set_id", "left")
    member = member.select("set_id", "n", F.coalesce("root", "set_id").alias("group")).join(sizes, "group", "left")
    return stored(member.select("set_id", "n", "group", F.coalesce("size", F.lit(1)).alias("size")))


def _several_groups(of_group: DataFrame) -> DataFrame:
    """The rows of tokens that members of two or more groups have."""
    several = of_group.groupBy("token").agg((F.min("group") != F.max("group")).alias("several")).where("several")
    return stored(of_group.join(several.select("token"), "token", "left_semi"))


def _in_blocks(bounded: DataFrame, members: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) of a set b and a member a of a group opened for it that size and signature allow.

    Sets and members of a group are dealt into blocks of about ``BLOCK`` each, and a task compares two blocks; so
    neither the pairs of a large group nor its members are ever rows of one task.
    """
    shape = bounded.groupBy("other", "size").agg(F.count("*").alias("sets"))
    shape = shape.select("other", *[F.ceil(F.col(c) / BLOCK).cast("int").alias(f"n_{c}") for c in ("size", "sets")])
    named = nodes.select("set_id", "n", "s")

    def dealt(side: DataFrame, key: str, number: int, own: str, across: str) -> DataFrame:
        rows = side.select("other", F.col(key).alias("set_id")).join(shape, "other").join(named, "set_id")
        mine = F.pmod(F.xxhash64("set_id"), F.col(own)).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.col(across) - 1)).alias(across)
        return rows.select("other", "set_id", "n", "s", mine, every, F.lit(number).alias("side")).select(
            "other", "n_size", "n_sets", "side", "set_id", "n", "s"
        )

    wanted = members.join(shape.select("other"), "other", "left_semi")
    both = dealt(wanted, "a", 0, "n_size", "n_sets").union(dealt(bounded, "b", 1, "n_sets", "n_size"))

    def compare(table):  # without type hints: they choose the kind of function here
        side, names = table.column("side").to_numpy(), table.column("set_id").to_numpy()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        found = [(names[left[i]], names[right[j]]) for i, j in _fitting(table, left, right)]
        a, b = zip(*found) if found else ([np.empty(0, np.int64)], [np.empty(0, np.int64)])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    return both.groupBy("other", "n_size", "n_sets").applyInArrow(compare, "a bigint, b bigint")


def _fitting(table: pa.Table, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in ``left`` and ``right`` of the rows that ``_may_link`` allows as a pair, few at a time."""
    n = table.column("n").to_numpy()
    lanes = table.column("s").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(n), _LANES)
    for at in range(0, len(right), 64):
        some = right[at : at + 64]
        small, large = np.minimum(n[left][:, None], n[some]), np.maximum(n[left][:, None], n[some])
        odd = sum(np.bitwise_count(lanes[left][:, None, k] ^ lanes[some][:, k]).astype(np.int64) for k in range(_LANES))
        i, j = np.nonzero((100 * small >= PERCENT * large) & (odd * (100 + PERCENT) <= (100 - PERCENT) * (small + large)))
        yield i, j + at


def _pairs_of_hot_tokens(of_group: DataFrame, hot: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets of different groups that share a hot token and that size and signature allow.

    The sets of a token are dealt into blocks of about ``BLOCK``, and a task compares two blocks of one token. A pair
    with several such tokens is returned at the first of them only.
    """
    mine = of_group.join(hot.select("token", F.ceil(F.col("sets") / BLOCK).cast("int").alias("blocks")), "token")
    hots = mine.groupBy("set_id").agg(F.sort_array(F.collect_set("token")).alias("hots"))  # of its prefix
    rows = mine.select("token", "blocks", "set_id", "group").join(nodes.select("set_id", "n", "s"), "set_id").join(hots, "set_id")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    kept = ["token", "set_id", "group", "n", "s", "hots"]
    later = F.explode(F.sequence(F.col("block"), F.col("blocks") - 1))
    sooner = F.explode(F.sequence(F.lit(0), F.col("block")))
    left = rows.select(*kept, F.col("block").alias("i"), later.alias("j"), F.lit(0).alias("side"))
    right = rows.select(*kept, sooner.alias("i"), F.col("block").alias("j"), F.lit(1).alias("side"))

    def compare(table):  # without type hints: they choose the kind of function here
        side, names = table.column("side").to_numpy(), table.column("set_id").to_numpy()
        group, token = table.column("group").to_numpy(), table.column("token")[0].as_py()
        itself = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        hots = [frozenset(h) for h in table.column("hots").to_pylist()]
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        out = []
        for i, j in _fitting(table, left, right):
            x, y = left[i], right[j]
            apart = (group[x] != group[y]) & ((names[x] < names[y]) | (not itself))
            out += [(p, q) for p, q in zip(x[apart].tolist(), y[apart].tolist()) if min(hots[p] & hots[q]) == token]
        a, b = (np.array([names[pair[k]] for pair in out], np.int64) for k in range(2))
        return pa.table({"a": a, "b": b})

    return left.union(right).groupBy("token", "i", "j").applyInArrow(compare, "a bigint, b bigint")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _texts_of(rows: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(set_id, text) of the sets that are in some pair, one text each."""
    wanted = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    names = stored(nodes.join(wanted, "set_id", "left_semi").select("set_id", "row"))
    if names.count() <= FEW:  # else the texts are shuffled
        names = F.broadcast(names)
    same = rows["doc_id"].eqNullSafe(names["row.doc_id"]) & (rows["text_id"] == names["row.text_id"])
    return stored(rows.join(names, same).select("set_id", "text").dropDuplicates(["set_id"]))
