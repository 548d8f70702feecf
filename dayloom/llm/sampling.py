"""Bounded samples for fitting: rows with the smallest hashes, of which few ever reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, functions as F


def smallest_marks(rows: DataFrame, total: int, n: int) -> list[Row]:
    """At most ``n`` rows with the smallest ``mark``, an even 64-bit hash; ``total`` is the number of rows.

    A threshold on the hash lets about 1.25 n + 50 rows through whatever the number of tasks, so no task sends its own
    ``n`` smallest.
    """
    share = min(1.0, (1.25 * n + 50) / max(total, 1))
    highest = min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
    few = rows.where(F.col("mark") <= F.lit(highest))
    return few.orderBy("mark", *[c for c in rows.columns if c != "mark"]).limit(n).collect()


def quotas(counts: dict[str, int], n: int) -> dict[str, int]:
    """How many of about ``n`` rows each label gives: all of small ones, the others even parts, one at least."""
    out, left = {}, n
    for i, (label, count) in enumerate(sorted(counts.items(), key=lambda c: (c[1], c[0]))):
        out[label] = min(count, max(1, left // (len(counts) - i)))
        left -= out[label]
    return out


def smallest_marks_by(rows: DataFrame, label: str, counts: dict[str, int], n: int) -> list[Row]:
    """The rows with the smallest ``mark`` of each label, as many as ``quotas`` gives it; ``counts`` are the labels' rows.

    Each label has a threshold of its own, so about 1.25 n + 50 rows a label reach the driver.
    """
    wanted = quotas(counts, n)
    if not wanted:
        return []
    drawn = {name: 1.25 * k + 50 for name, k in wanted.items()}
    shares = [(name, min(1.0, drawn[name] / counts[name])) for name in wanted]
    limits = rows.sparkSession.createDataFrame(shares, f"`{label}` string, share double")
    place = F.col("mark") / F.lit(float(1 << 64)) + F.lit(0.5)  # of the mark among all, from 0 to 1
    few = rows.join(F.broadcast(limits), label).withColumn("place", place / F.col("share")).where("place <= 1")
    ordered = few.orderBy("place", "mark", *[c for c in rows.columns if c != "mark"])
    out: list[Row] = []
    for row in ordered.limit(int(2 * sum(drawn.values()))).collect():
        if wanted[row[label]]:
            wanted[row[label]] -= 1
            out.append(row)
    return out
