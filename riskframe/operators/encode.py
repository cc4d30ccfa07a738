"""Encodings fitted on one slice and applied to any rows: counts and means.

Missing is a value like any other: it is counted at fit time and found again at
apply time.  A key not seen at fit time has count 0 and no mean.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.columns import key_text, ratio_to_mean
from riskframe.operators.positions import number_rows
from riskframe.operators.skew import BROADCAST_ROWS, HOT_ROWS, hot_tables, known_hot, lookup_join
from riskframe.schema import ACCOUNT_KEYS, FREQUENCY_KEYS, GROUP_KEYS
from riskframe.session import fresh_path, materialise, together
from riskframe.sources import versions

# Frames with more columns than this are not shuffled by key.
WIDE_COLUMNS = 64

_SUMS = ["n", "n_amt", "sum_amt"]
# The finest key sets; every other map is a sum over one of them.
_BASES = {"account": ACCOUNT_KEYS, "card_mail": ["card1", "P_emaildomain"]}


def fit_counts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key → number of rows; the missing key is one of the keys."""
    return rows.groupBy(*keys).agg(F.count("*").alias("cnt"))


def fit_group(rows: DataFrame, keys: Sequence[str], amount: str = "amt_log") -> DataFrame:
    """Key → row count and mean amount; missing amounts count but do not average."""
    return rows.groupBy(*keys).agg(
        F.count("*").alias("cnt"), F.avg(F.col(amount).cast("double")).alias("mean_amt")
    )


def _sums(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    amount = F.col("amt_log").cast("double")
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count(amount).alias("n_amt"), F.sum(amount).alias("sum_amt")
    )


def _rollup(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    return sums.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _SUMS])


def _as_counts(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    return sums.select(*keys, F.col("n").alias("cnt"))


def _as_group(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    mean = F.col("sum_amt") / F.nullif(F.col("n_amt"), F.lit(0))
    return sums.select(*keys, F.col("n").alias("cnt"), mean.alias("mean_amt"))


@dataclass
class Encodings:
    """Fitted tables by name, with their row counts (which decide how they join)."""

    counts: dict[str, DataFrame]
    groups: dict[str, DataFrame]
    n_rows: dict[str, int]
    path: str

    def copy_to(self, path: str) -> None:
        """Store the base tables at ``path``, from where ``load_encodings`` reads them."""
        if path.rstrip("/") != self.path.rstrip("/"):
            spark = SparkSession.active()
            for name in _BASES:
                spark.read.parquet(f"{self.path}/{name}").write.mode("overwrite").parquet(f"{path}/{name}")

    def tables(self) -> dict[str, DataFrame]:
        return {**self.counts, **{f"group_{k}": v for k, v in self.groups.items()}}

    def long_table(self) -> DataFrame:
        """All fitted values as (map, key, cnt, mean_amt) with text keys, to export."""
        parts = []
        for name, table in self.tables().items():
            keys = [c for c in table.columns if c not in ("cnt", "mean_amt")]
            mean = F.col("mean_amt") if "mean_amt" in table.columns else F.lit(None).cast("double")
            parts.append(table.select(
                F.lit(name).alias("map"), key_text(*[F.col(k) for k in keys]).alias("key"), "cnt", mean.alias("mean_amt")
            ))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out


def fit_encodings(train: DataFrame, path: str | None = None) -> Encodings:
    """Fit every map on the rows given, and replace those at ``path`` by them, all at once (see ``versions``).

    Two passes shuffle partial sums of the rows: by account and by card and
    e-mail.  The coarser maps are sums of those two tables.
    """
    path = path or fresh_path(train.sparkSession, "encodings")
    version = versions.begin(path)

    def write(name: str) -> None:
        _sums(train, _BASES[name]).write.parquet(f"{version}/{name}")

    together(*[partial(write, name) for name in _BASES])
    versions.publish(train.sparkSession, path, version)
    return load_encodings(train.sparkSession, path)


def load_encodings(spark: SparkSession, path: str, broadcast_rows: int = BROADCAST_ROWS) -> Encodings:
    """The maps as written by ``fit_encodings``; nothing is fitted again.

    While a base table is small enough to broadcast, its size bounds the size of
    every coarser map.  Beyond that the coarser maps are written once and counted.
    """
    path = versions.resolve(spark, path)

    def read(name: str) -> tuple[DataFrame, int]:
        table = spark.read.parquet(f"{path}/{name}")
        return table, table.count()

    stored = dict(zip(_BASES, together(*[partial(read, name) for name in _BASES])))

    def sums(keys: Sequence[str]) -> tuple[DataFrame, int]:
        name = next(n for n, of in _BASES.items() if set(keys) <= set(of))
        if set(keys) == set(_BASES[name]):
            return stored[name]
        base, size = stored[name]
        coarser = _rollup(base, keys)
        if size <= broadcast_rows:
            return coarser, size
        written = materialise(coarser, "map")
        return written, written.count()

    fitted = {tuple(k): sums(k) for k in [*FREQUENCY_KEYS.values(), *(k for k, _ in GROUP_KEYS.values())]}
    counts = {f: _as_counts(fitted[tuple(k)][0], k) for f, k in FREQUENCY_KEYS.items()}
    groups = {g: _as_group(fitted[tuple(k)][0], k) for g, (k, _) in GROUP_KEYS.items()}
    n_rows = {f: fitted[tuple(k)][1] for f, k in FREQUENCY_KEYS.items()}
    n_rows |= {g: fitted[tuple(k)][1] for g, (k, _) in GROUP_KEYS.items()}
    return Encodings(counts, groups, n_rows, path)


def apply_counts(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], alias: str, table_rows: int | None = None, **limits
) -> DataFrame:
    joined = lookup_join(rows, table.withColumnRenamed("cnt", "_cnt"), keys, table_rows, **limits)
    return joined.withColumn(alias, F.coalesce(F.col("_cnt"), F.lit(0)).cast("float")).drop("_cnt")


def apply_group(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], name: str, stats: Sequence[str],
    table_rows: int | None = None, **limits,
) -> DataFrame:
    fitted = table.select(*keys, F.col("cnt").alias("_cnt"), F.col("mean_amt").alias("_mean"))
    out = lookup_join(rows, fitted, keys, table_rows, **limits)
    if "count" in stats:
        out = out.withColumn(f"{name}_count", F.coalesce(F.col("_cnt"), F.lit(0)).cast("float"))
    if "mean_amt" in stats:
        out = out.withColumn(f"{name}_mean_amt", F.col("_mean").cast("float"))
    return out.drop("_cnt", "_mean")


def apply_encodings(
    rows: DataFrame, fitted: Encodings, broadcast_rows: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS,
    maps: Sequence[str] | None = None,
) -> DataFrame:
    """Add every fitted count and mean (of ``maps`` only, if given), and the amount relative to its card's mean, if that is
    among them.

    Hot keys for the maps too large to broadcast are found once, before the first join.
    """
    wanted = [*FREQUENCY_KEYS, *GROUP_KEYS] if maps is None else list(maps)
    used = {**FREQUENCY_KEYS, **{name: keys for name, (keys, _) in GROUP_KEYS.items()}}
    used = {name: used[name] for name in wanted}
    large = list(dict.fromkeys(tuple(k) for name, k in used.items() if fitted.n_rows[name] > broadcast_rows))
    if rows.isStreaming:
        fits = {tuple(used[name]): fitted.counts.get(name, fitted.groups.get(name)) for name in used}
        hot = {keys: known_hot(fits[keys], keys, "cnt", hot_rows) for keys in large}
    else:
        hot = dict(zip(large, hot_tables(rows, large, hot_rows))) if large else {}
    limits = lambda keys: dict(broadcast_rows=broadcast_rows, hot_rows=hot_rows, hot=hot.get(tuple(keys)))
    out = rows
    # Maps that move the rows go first, while the rows are short.
    for name in sorted(used, key=lambda name: fitted.n_rows[name] <= broadcast_rows):
        keys = used[name]
        if name in FREQUENCY_KEYS:
            out = apply_counts(out, fitted.counts[name], keys, name, fitted.n_rows[name], **limits(keys))
        else:
            out = apply_group(out, fitted.groups[name], keys, name, GROUP_KEYS[name][1], fitted.n_rows[name], **limits(keys))
    stats = [f"{name}_{stat}" for name, (_, of) in GROUP_KEYS.items() for stat in of]
    out = out.select(*rows.columns, *[c for c in [*FREQUENCY_KEYS, *stats] if c in out.columns and c not in rows.columns])
    if "card1_mean_amt" not in out.columns:
        return out
    return out.withColumn("amt_to_card1_mean_ratio", ratio_to_mean(F.col("amt_log"), F.col("card1_mean_amt")))


def fit_dictionary(rows: DataFrame, columns: Sequence[str], counts: bool = False) -> DataFrame:
    """Value → code per column, codes following the text order of the values; with
    ``counts`` also the rows that hold the value, as ``seen``.

    Vocabularies may be as long as the data (cards, accounts), so the codes come
    from a range-partitioned numbering, not from one window per column.
    """
    melted = rows.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    values = melted.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("seen"))
    numbered = number_rows(values, ["column", "value"], "_number")
    first = numbered.groupBy("column").agg(F.min("_number").alias("_first"))
    return numbered.join(F.broadcast(first), "column").select(
        "column", "value", (F.col("_number") - F.col("_first")).alias("code"), *(["seen"] if counts else [])
    )


def apply_dictionary(rows: DataFrame, dictionary: DataFrame, column: str, alias: str, **limits: int) -> DataFrame:
    """Code of a column's value; missing and unseen values have none."""
    codes = dictionary.where(F.col("column") == column).select(F.col("value").alias("_value"), F.col("code").alias(alias))
    keyed = rows.withColumn("_value", F.col(column).cast("string"))
    return lookup_join(keyed, codes, ["_value"], **limits).drop("_value")


def apply_vocabulary(
    rows: DataFrame, vocabulary: DataFrame, n_rows: dict[str, int], broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS, unique_id: str | None = None,
) -> DataFrame:
    """``{c}_code``, ``{c}_seen`` and ``{c}_missing`` for each text column of ``n_rows`` (column → number of its values).

    Values not in the vocabulary have code -1 and were seen 0 times; so have missing ones, which the flag tells apart.
    Several columns whose vocabulary is too large to broadcast, or one of wide rows, are looked up together, see
    ``_look_up_beside``, if ``unique_id`` names a column that tells all rows apart; else ``rows`` is shuffled for each of them.
    """
    large = [c for c, n in n_rows.items() if n > broadcast_rows]
    beside = large if unique_id and not rows.isStreaming and (len(large) > 1 or len(rows.columns) > WIDE_COLUMNS) else []
    out = _look_up_beside(rows, vocabulary, {c: n_rows[c] for c in beside}, hot_rows, unique_id) if beside else rows
    salted = [c for c in large if c not in beside]
    if rows.isStreaming:
        of = lambda c: vocabulary.where(F.col("column") == c).select(F.col("value").alias(c), "seen")
        hot = {c: known_hot(of(c), [c], "seen", hot_rows) for c in salted}
    else:
        hot = dict(zip(salted, hot_tables(rows, [[c] for c in salted], hot_rows))) if salted else {}
    # Vocabularies that move the rows go first, while the rows are short.
    for c, n in sorted(n_rows.items(), key=lambda item: item[1] <= broadcast_rows):
        if c not in beside:
            own = vocabulary.where(F.col("column") == c).select(
                F.col("value").alias(c), F.col("code").cast("double").alias(f"{c}_code"), F.col("seen").cast("double").alias(f"{c}_seen"))
            out = lookup_join(out, own, [c], n, broadcast_rows, hot_rows, hot=hot.get(c), spread_by=rows.columns[0])
    unseen = {f"{c}_{kind}": F.coalesce(f"{c}_{kind}", F.lit(value)) for c in n_rows for kind, value in (("code", -1.0), ("seen", 0.0))}
    return out.withColumns({**unseen, **{f"{c}_missing": F.col(c).isNull().cast("double") for c in n_rows}})


def _look_up_beside(
    rows: DataFrame, vocabulary: DataFrame, n_rows: dict[str, int], hot_rows: int, unique_id: str
) -> DataFrame:
    """``{c}_code`` and ``{c}_seen`` of several columns from one join of (id, column, value) with the vocabulary.

    What moves by value is that narrow table, with its hot values spread; its results are gathered by id, and ``rows``
    moves once, by id, or not at all if that is how it already lies.
    """
    columns = list(n_rows)
    values = rows.select(unique_id, *columns).unpivot([unique_id], columns, "_column", "_value").where(F.col("_value").isNotNull())
    own = vocabulary.where(F.col("column").isin(columns)).select(
        F.col("column").alias("_column"), F.col("value").alias("_value"), F.col("code").cast("double"), F.col("seen").cast("double"))
    coded = lookup_join(values, own, ["_column", "_value"], sum(n_rows.values()), 0, hot_rows, spread_by=unique_id)
    gathered = coded.groupBy(unique_id).agg(*[
        F.max(F.when(F.col("_column") == c, F.col(kind))).alias(f"{c}_{kind}") for c in columns for kind in ("code", "seen")])
    return rows.join(gathered.hint("shuffle_hash"), unique_id, "left")
