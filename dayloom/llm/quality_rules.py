"""Quality rules as a ledger: every rule is evaluated once per document, its failure is one bit of a long.

``ledger`` stores measurements and ``fail_bits``; a policy is a mask over the rules, so versions of a policy and their
ablations need no text again, only bit operations on the ledger.

Words are runs of characters other than space and ``\\t \\n \\v \\f \\r``. Measured per text: ``n_words``; ``word_chars``,
code points in words; ``n_symbols``, characters of ``#*$%&|<>``; ``n_lines``, \\n-split lines with a word;
``n_dup_lines``, those equal to an earlier one; ``n_repeat_words``, words in 5-word windows that the text holds twice or
more, the first ones included; ``n_stutter``, words equal to the one before.

Everything is an expression over one row: no shuffle, no Python, no limit on the length of a text. Windows are compared
by a 64-bit hash within one text; only texts in which some hash repeats are sorted.

Defined results: a null or empty text has no words and fails "few words"; rows are judged one by one, so equal rows get
equal ledgers; an empty table gives an empty ledger; ``keys`` are carried along, other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: name -> (condition of failure, in whole numbers; a text without words fails only the first)
RULES = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > 2 * n_words AND n_words > 0",
    "duplicate_lines": "100 * n_dup_lines > 30 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "many_words": "n_words > 1000000",
    "stutter": "100 * n_stutter > 40 * n_words AND n_words > 0",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_windows"]
#: version -> mask of the rules that reject
POLICIES = {
    "base": BASE,
    "v1": BASE | BIT["symbols"] | BIT["duplicate_lines"],
    # duplicate lines alone also reject documents labelled good (``ablation`` shows it), so v2 drops that rule
    "v2": BASE | BIT["symbols"] | BIT["short_words"] | BIT["long_words"] | BIT["many_words"] | BIT["stutter"],
    # neither its size nor a script without spaces makes a text bad: many words reject nothing, long words see ``TOGETHER``
    "v3": BASE | BIT["symbols"] | BIT["short_words"] | BIT["stutter"],
}
#: version -> mask of rules that reject only if a document fails all of them
TOGETHER = {"v3": BIT["long_words"] | BIT["duplicate_lines"]}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stutter"]

_BLANKS = "[\\\\x20\\\\x09-\\\\x0D]+"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _repeat_words(words: str) -> str:
    window = ", ".join(f"get({words}, i + {k})" for k in range(5))
    hashes = f"transform(sequence(0, size({words}) - 5), i -> xxhash64({window}))"
    by_hash = "array_sort(transform(h, (x, i) -> struct(x AS x, i AS i)))"
    twice = "filter(s, (a, i) -> a.x <=> get(s, i - 1).x OR a.x <=> get(s, i + 1).x)"
    places = f"array_sort(transform({twice}, a -> a.i))"
    covered = "aggregate(transform(p, (a, i) -> least(5, coalesce(get(p, i + 1) - a, 5))), 0L, (n, x) -> n + x)"
    slow = _let("s", by_hash, _let("p", places, covered))
    any_twice = f"CASE WHEN size(array_distinct(h)) = size(h) THEN 0L ELSE {slow} END"
    return f"CASE WHEN size({words}) < 6 THEN 0L ELSE {_let('h', hashes, any_twice)} END"


def measurements(text: str) -> Column:
    """A struct of ``MEASURES`` for the text column."""
    t = f"coalesce(`{text}`, '')"
    words = f"filter(split({t}, '{_BLANKS}'), x -> x != '')"
    lines = f"filter(split({t}, '\\n'), x -> x RLIKE '[^\\\\x20\\\\x09-\\\\x0D]')"
    of_words = f"""named_struct(
        'n_words', CAST(size(w) AS BIGINT),
        'word_chars', aggregate(w, 0L, (n, x) -> n + length(x)),
        'n_repeat_words', {_repeat_words('w')},
        'n_stutter', CAST(size(filter(w, (x, i) -> x <=> get(w, i - 1))) AS BIGINT))"""
    of_lines = """named_struct(
        'n_lines', CAST(size(l) AS BIGINT),
        'n_dup_lines', CAST(size(l) - size(array_distinct(l)) AS BIGINT))"""
    symbols = f"CAST(length({t}) - length(translate({t}, '#*$%&|<>', '')) AS BIGINT)"
    return F.expr(
        f"named_struct('words', {_let('w', words, of_words)}, 'lines', {_let('l', lines, of_lines)}, "
        f"'n_symbols', {symbols})"
    )


def ledger(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys``, the measurements and ``fail_bits`` of every row."""
    where = {"n_symbols": "m.n_symbols", "n_lines": "m.lines.n_lines", "n_dup_lines": "m.lines.n_dup_lines"}
    measured = docs.select(*[F.col(f"`{k}`") for k in keys], measurements(text).alias("m"))
    flat = measured.select(*[f"`{k}`" for k in keys], *[F.col(where.get(m, f"m.words.{m}")).alias(m) for m in MEASURES])
    bits = " | ".join(f"CASE WHEN {rule} THEN {BIT[name]}L ELSE 0L END" for name, rule in RULES.items())
    return flat.withColumn("fail_bits", F.expr(bits))


def fails(mask: int) -> Column:
    """Whether a row of the ledger fails any rule of the mask."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask)) != 0


def rejected(policy: str) -> Column:
    """Whether a version of the policy rejects a row of the ledger."""
    mask = TOGETHER.get(policy)
    alone = fails(POLICIES[policy])
    return alone if mask is None else alone | (F.col("fail_bits").bitwiseAND(F.lit(mask)) == F.lit(mask))


def ablation(rows: DataFrame, mask: int, together: int = 0) -> DataFrame:
    """One row per rule of the policy: how many it fails, and how many it alone fails (kept without it).

    The rules of ``together``, which reject only as one, are one row, their names joined by ``+``.
    """
    names = [n for n in RULES if BIT[n] & mask]
    masked = F.col("fail_bits").bitwiseAND(F.lit(mask))
    both = F.lit(together != 0) & (F.col("fail_bits").bitwiseAND(F.lit(together)) == together)
    failed = {n: masked.bitwiseAND(F.lit(BIT[n])) != 0 for n in names}
    alone = {n: (masked == F.lit(BIT[n])) & ~both for n in names}
    if together:
        joint = "+".join(n for n in RULES if BIT[n] & together)
        failed[joint], alone[joint] = both, both & (masked == 0)
    if not failed:
        return rows.sparkSession.createDataFrame([], "rule string, failed bigint, alone bigint")
    sums = rows.agg(
        *[F.count_if(c).alias(f"{n}_failed") for n, c in failed.items()],
        *[F.count_if(c).alias(f"{n}_alone") for n, c in alone.items()],
    )
    each = [F.struct(F.lit(n).alias("rule"), F.col(f"{n}_failed").alias("failed"), F.col(f"{n}_alone").alias("alone"))
            for n in failed]
    return sums.select(F.inline(F.array(*each)))


def policy_ablation(rows: DataFrame, policy: str) -> DataFrame:
    return ablation(rows, POLICIES[policy], TOGETHER.get(policy, 0))


def judged(docs: DataFrame, policy: str = "v3") -> DataFrame:
    """(doc_id, measurements, fail_bits, base_failed, kept) by a version of the policy."""
    return ledger(docs, ["doc_id"]).select(
        "doc_id", *MEASURES, "fail_bits", fails(BASE).alias("base_failed"), (~rejected(policy)).alias("kept")
    )


def keep_good(docs: DataFrame, policy: str = "v3") -> DataFrame:
    """The rows of ``docs`` that no rule of the policy rejects, all columns kept.

    The ledger columns live beside the row in one struct, so no column name of ``docs`` can clash with them.
    """
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").alias("text"))
    kept = ledger(row, ["row"]).where(~rejected(policy))
    return kept.select("row.*")


JUDGED_SQL = r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
    line AS (SELECT r, l FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d)
             WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
    lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines FROM line GROUP BY r),
    win AS (SELECT r, i, w[i:i + 4] AS v FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) > 4)),
    twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, v) AS n FROM win) WHERE n > 1),
    covered AS (SELECT r, count(DISTINCT p) AS n_repeat_words
                FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r),
    m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
                 CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
                 CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                 coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
                 coalesce(n_repeat_words, 0) AS n_repeat_words,
                 (SELECT count(*) FROM range(2, len(w) + 1) t(i) WHERE w[i] = w[i - 1]) AS n_stutter
          FROM w LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)),
    b AS (SELECT *, """ + " + ".join(f"CASE WHEN {rule} THEN {BIT[n]} ELSE 0 END" for n, rule in RULES.items()) + f""" AS bits FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_stutter,
           CAST(bits AS BIGINT) AS fail_bits, bits & {BASE} <> 0 AS base_failed,
           bits & {POLICIES['v3']} = 0 AND bits & {TOGETHER['v3']} <> {TOGETHER['v3']} AS kept
    FROM b"""
