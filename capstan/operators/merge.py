"""pandas-style merge: NULL keys match each other, clashing names get suffixes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from capstan.operators.sinks import read_report, write_report
from capstan.session import stored_table

TILE = 1 << 12                            # rows of one key, on each side, that are joined at once
MAX_TILE_PARTITIONS = 4096


def null_safe_merge(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
                    suffixes: tuple[str, str] = ("_x", "_y"), hot_right_keys: bool = False,
                    null_keys: str = "match", counts: "MergeCounts | None" = None) -> DataFrame:
    """Join like ``pandas.merge(left, right, on=on, how=how, suffixes=suffixes)``.

    * ``null_keys='match'`` (pandas): keys compare with ``<=>``, so NULL matches
      NULL; Spark still plans an equi-join on (coalesce(key), isnull(key)) pairs.
      The output has NULL-left x NULL-right rows, so it grows with the product
      of both groups.  ``grouped_merge`` holds the same result in linear space.
    * ``null_keys='never'`` (SQL): a NULL key matches nothing; wanted when NULL
      means "unknown".  The output stays linear however many NULLs there are.
    * one copy of each key column (the left one, coalesced for right/outer)
    * non-key columns present on both sides get ``suffixes``
    * column order: left columns, then right non-key columns

    ``hot_right_keys=True`` (left merges) runs the merge as an inner join
    plus an anti join against the de-duplicated right keys, so adaptive
    execution can split a right-side key holding a large share of the rows
    (a left outer join can only be split on its left side).  The left input
    is read by both branches; use it where the left side is cheap to read.
    Keys with more than ``TILE`` x ``TILE`` pairs of rows are found first (an
    eager count of both sides' keys) and their pairs dealt over tasks: a key
    with few bytes but many pairs is never split by adaptive execution.

    ``counts`` (left merges without ``hot_right_keys``) counts rows while the
    merge runs: see ``MergeCounts``.
    """
    on = list(on)
    if counts is not None:
        if hot_right_keys or how != "left":
            raise ValueError("counts go with plain left merges")
        left, right = counts.watch_left(left, on), right.withColumn("__matched", F.lit(1))
    lcols, rcols = left.columns, right.columns
    shared = (set(lcols) & set(rcols)) - set(on)
    lsel = [F.col(c).alias(c + suffixes[0] if c in shared else c) for c in lcols]
    rsel = [F.col(c).alias(f"__rk_{c}") for c in on] + \
           [F.col(c).alias(c + suffixes[1] if c in shared else c) for c in rcols if c not in on]
    l, r = left.select(*lsel), right.select(*rsel)
    if null_keys not in ("match", "never"):
        raise ValueError(f"null_keys must be 'match' or 'never', not {null_keys!r}")
    if null_keys == "match":
        cond = [F.col(k).eqNullSafe(F.col(f"__rk_{k}")) for k in on]
    else:
        cond = [F.col(k) == F.col(f"__rk_{k}") for k in on]
    if hot_right_keys and how == "left":
        matched = _tiled(l, r, on, cond)
        keys = r.select(*[f"__rk_{k}" for k in on]).distinct()
        unmatched = l.join(keys, cond, "left_anti")
        joined = matched.unionByName(unmatched, allowMissingColumns=True)
    else:
        joined = l.join(r, cond, {"left": "left", "inner": "inner", "right": "right", "outer": "full"}[how])
    out = []
    for c in l.columns:
        if c in on and how in ("right", "outer"):
            out.append(F.coalesce(F.col(c), F.col(f"__rk_{c}")).alias(c))
        else:
            out.append(F.col(c))
    out += [F.col(c) for c in r.columns if not c.startswith("__rk_")]
    joined = joined.select(*out)
    return joined if counts is None else counts.watch_result(joined).drop("__matched")


def _tiled(l: DataFrame, r: DataFrame, on: Sequence[str], cond: list[Column]) -> DataFrame:
    """``l.join(r, cond, "inner")`` with the pairs of a hot key dealt over many tasks.

    The rows of a hot key are cut into slices of about ``TILE`` on either side, and every
    left slice meets every right slice in a tile of its own; a row is copied once for each
    slice of the other side.  Hot rows are stored with their slice, so that a task that runs
    again finds them in the same one.
    """
    theirs = [f"__rk_{k}" for k in on]
    left_rows, right_rows = l.groupBy(*on).agg(F.count(F.lit(1)).alias("__l")), r.groupBy(*theirs).agg(F.count(F.lit(1)).alias("__r"))
    # keys of TILE**2 pairs or more have 2 * TILE rows at least: few beside the rows
    hot = stored_table(left_rows.join(right_rows, cond, "inner").where(F.col("__l") > F.lit(TILE * TILE) / F.col("__r"))
                       .select(*[F.col(k).alias(f"__hk_{k}") for k in on], F.monotonically_increasing_id().alias("__class"),
                               F.ceil(F.col("__l") / TILE).alias("__a"), F.ceil(F.col("__r") / TILE).alias("__b")), "merge-hot-keys")
    tiles = hot.agg(F.sum(F.col("__a") * F.col("__b"))).first()[0]
    if not tiles:
        return l.join(r, cond, "inner")
    chosen = F.broadcast(hot)

    def sliced(rows: DataFrame, keys: Sequence[str], own: str, other: str, i: str, j: str) -> DataFrame:
        found = rows.join(chosen, [F.col(k).eqNullSafe(F.col(f"__hk_{n}")) for k, n in zip(keys, on)], "inner")
        found = found.select(*rows.columns, "__class", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col(own)).alias(i), other)
        return (stored_table(found, "merge-hot-rows")
                .select(*rows.columns, "__class", i, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1)).alias(j))
                .repartition(min(tiles, MAX_TILE_PARTITIONS), "__class", "__i", "__j"))

    pairs = sliced(l, on, "__a", "__b", "__i", "__j").hint("merge").join(sliced(r, theirs, "__b", "__a", "__j", "__i").hint("merge"), ["__class", "__i", "__j"], "inner")
    cold = l.join(chosen, [F.col(k).eqNullSafe(F.col(f"__hk_{k}")) for k in on], "left_anti").join(r, cond, "inner")
    return cold.unionByName(pairs.select(*cold.columns))


class MergeCounts:
    """Row counts of a left merge, taken while it runs (``DataFrame.observe``): no second pass.

    One instance per merge.  After the action that runs the merge, ``get()`` has
    ``left_rows``, ``left_null_keys`` (rows with a NULL key column), ``merged_rows``,
    ``matched_rows`` and ``unmatched_rows`` (merged rows with and without a right partner).
    The numbers come from the tasks that count for the result; a stage that Spark runs again
    after losing an executor's output may be counted twice.
    """

    def __init__(self) -> None:
        self._left, self._result = Observation(), Observation()

    def watch_left(self, left: DataFrame, on: Sequence[str]) -> DataFrame:
        null_key = F.lit(False)
        for k in on:
            null_key = null_key | F.col(k).isNull()
        return left.observe(self._left, F.count(F.lit(1)).alias("left_rows"), F.count_if(null_key).alias("left_null_keys"))

    def watch_result(self, joined: DataFrame) -> DataFrame:
        return joined.observe(self._result, F.count(F.lit(1)).alias("merged_rows"), F.count("__matched").alias("matched_rows"))

    def get(self) -> dict[str, int]:
        out = {**self._left.get, **self._result.get}
        return {**out, "unmatched_rows": out["merged_rows"] - out["matched_rows"]}


@dataclass(frozen=True)
class GroupedMerge:
    """A left merge in linear space: rows of equal keys are one class, and its members are held once.

    * ``classes``: one row per distinct key of the left side (NULL is a key value like any
      other): the key columns, ``left_rows``, ``right_rows`` and ``merged_rows``, the number of
      rows that the merge has for this key
    * ``left``: the left rows; ``right``: the right rows whose key the left side has

    ``expand()`` gives the pandas result; with a condition on the class columns only those
    classes are expanded (``~F.col("PartNumber").isNull()``, ``F.col("merged_rows") < 1000``).
    """

    classes: DataFrame
    left: DataFrame
    right: DataFrame
    on: tuple[str, ...]
    suffixes: tuple[str, str] = ("_x", "_y")

    def merged_rows(self) -> int:
        """Rows of the expanded merge, without expanding it."""
        return self.classes.agg(F.coalesce(F.sum("merged_rows"), F.lit(0))).first()[0]

    def expand(self, where: Column | str | None = None) -> DataFrame:
        left, right = self.left, self.right
        if where is not None:
            chosen = self.classes.where(where)
            left, right = _semi(left, chosen, self.on), _semi(right, chosen, self.on)
        return null_safe_merge(left, right, self.on, suffixes=self.suffixes, hot_right_keys=True)

    def write(self, path: str) -> None:
        """Three reports below ``path``; rows written grow with the sum of both sides."""
        for name in ("left", "right", "classes"):
            write_report(getattr(self, name), f"{path}/{name}")

    @classmethod
    def read(cls, spark: SparkSession, path: str, on: Sequence[str], suffixes: tuple[str, str] = ("_x", "_y")) -> "GroupedMerge":
        return cls(*[read_report(spark, f"{path}/{n}") for n in ("classes", "left", "right")], tuple(on), suffixes)


def grouped_merge(left: DataFrame, right: DataFrame, on: Sequence[str], suffixes: tuple[str, str] = ("_x", "_y")) -> GroupedMerge:
    """``pandas.merge(left, right, on=on, how="left")`` as classes of equal keys (see ``GroupedMerge``).

    Both sides are counted per key before anything is joined, so the join has one row per
    key on each side, however many rows share a key.
    """
    on = tuple(on)
    ours = left.groupBy(*on).agg(F.count(F.lit(1)).alias("left_rows"))
    theirs = right.groupBy(*[F.col(k).alias(f"__rk_{k}") for k in on]).agg(F.count(F.lit(1)).alias("right_rows"))
    classes = ours.join(theirs, [F.col(k).eqNullSafe(F.col(f"__rk_{k}")) for k in on], "left").select(
        *on, "left_rows", F.coalesce("right_rows", F.lit(0)).alias("right_rows"),
        (F.col("left_rows") * F.greatest(F.coalesce("right_rows", F.lit(0)), F.lit(1))).alias("merged_rows"))
    return GroupedMerge(classes, left, _semi(right, ours, on), on, suffixes)


def _semi(rows: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """``rows`` whose key is in ``keys`` (one row per key), NULL equal to NULL; a hot key of ``rows`` can be split.

    The key is a struct of values and their NULL flags, so that the side of ``keys``, which
    comes out of an aggregation, gets an exchange of its own.
    """
    key = F.struct(*[x for k in on for x in (F.col(k).alias(k), F.col(k).isNull().alias(f"{k}_null"))])
    left, right = rows.withColumn("__key", key), keys.select(key.alias("__right_key"))
    return left.join(right, F.col("__key").eqNullSafe(F.col("__right_key")), "left_semi").drop("__key")
