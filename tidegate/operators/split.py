"""Accept / reject split of a raw snapshot.

Each row is judged in one projection; a caller who needs more than one output stores
the judged rows first, as the loads do, so that they are judged once. Key repeats are
then counted among the rows that passed, and every row sharing a repeated key is
rejected too; an invalid twin does not harm a valid row.

The count is an aggregate on the two key columns only, so a key that holds a
third of the file collapses before the shuffle and no task ever holds a group.
The repeated keys are joined back instead of being carried by a window: wide
rows only move when the list of repeated keys is too large to broadcast, and
then Spark splits a skewed key's partition by itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.functions import fits, max_len, number_rest, to_number
from tidegate.operators import rules as R
from tidegate.operators.joins import flag_supported
from tidegate.schemas import Dataset, Field


class Split(NamedTuple):
    stage: DataFrame
    reject: DataFrame


def judge_transfers(raw: DataFrame, ref_currency: DataFrame, ref_country: DataFrame) -> DataFrame:
    """Normalise, parse and judge transfers; adds ``reject_reason`` (NULL when valid)."""
    rows = R.parse(R.normalise(raw, S.TRANSFERS), S.TRANSFERS)
    rows = flag_supported(
        rows, ref_currency, "currency_code", S.CURRENCY_FORMAT, "is_supported_currency"
    )
    rows = flag_supported(
        rows, ref_country, "country_code", S.COUNTRY_FORMAT, "is_supported_country"
    )
    return _with_reason(rows, R.transfer_rules())


def judge_clients(raw: DataFrame) -> DataFrame:
    """Normalise, parse and judge clients; adds ``reject_reason`` (NULL when valid)."""
    rows = R.parse(R.normalise(raw, S.CLIENTS), S.CLIENTS)
    return _with_reason(rows, R.client_rules())


def _with_reason(rows: DataFrame, rules: list[R.Rule]) -> DataFrame:
    """Add ``reject_reason`` through a one-element generator.

    As a plain column, a later filter on it would be pushed below the projections
    with all rules, parsers and normalisers copied into it, several times over: code
    too large to compile, evaluated once more for the column itself. Filters do not
    pass a generator on its own output.
    """
    reason = F.struct(R.reject_reason(rules).alias("reject_reason"))
    return rows.select("*", F.inline(F.array(reason)))


def duplicate_keys(judged: DataFrame, dataset: Dataset) -> DataFrame:
    """(business_date, key, key_rest, key_rows) of keys that more than one valid row carries.

    Keys are compared as exact numbers, before rounding to the stored type.
    """
    key = dataset.field(dataset.key)
    return (
        judged.filter(F.col("reject_reason").isNull())
        .groupBy("business_date", key.parsed, number_rest(key.raw).alias("key_rest"))
        .agg(F.count("*").alias("key_rows"))
        .filter("key_rows > 1")
    )


def _repeated(dataset: Dataset) -> Column:
    """The reason of a valid row whose key repeats."""
    return F.lit(f"duplicate {dataset.key} in snapshot")


def split_judged(
    judged: DataFrame, dataset: Dataset, duplicates: DataFrame | None = None
) -> Split:
    """Split judged rows; ``duplicates`` may be passed in when already computed."""
    if duplicates is None:
        duplicates = duplicate_keys(judged, dataset)
    keys, on = _repeated_keys(duplicates, dataset)
    accepted = judged.filter(F.col("reject_reason").isNull()).join(keys, on, "left_anti")
    return Split(
        stage=accepted.select(
            "business_date",
            "source_row_num",
            *[typed(dataset.field(n)).alias(n) for n in dataset.stage_order],
        ),
        reject=rejected(judged, dataset, duplicates),
    )


def _repeated_keys(duplicates: DataFrame, dataset: Dataset) -> tuple[DataFrame, Column]:
    """The repeated keys, and how judged rows meet them.

    Null-safe, because a plain equality would also filter the keys for NULL below the
    judging, where their parsers would run a second time.
    """
    key, key_raw = dataset.field(dataset.key).parsed, dataset.field(dataset.key).raw
    on = F.col("business_date").eqNullSafe(F.col("repeated_date")) & F.col(key).eqNullSafe(
        F.col("repeated_key")
    ) & number_rest(key_raw).eqNullSafe(F.col("repeated_rest"))
    keys = duplicates.select(
        F.col("business_date").alias("repeated_date"),
        F.col(key).alias("repeated_key"),
        F.col("key_rest").alias("repeated_rest"),
    )
    return keys, on


def rejected(judged: DataFrame, dataset: Dataset, duplicates: DataFrame | None = None) -> DataFrame:
    """The reject side of a split alone; of the judged rows only ``reject_inputs`` are read."""
    if duplicates is None:
        duplicates = duplicate_keys(judged, dataset)
    keys, on = _repeated_keys(duplicates, dataset)
    # An invalid row that shares a repeated key keeps its own reason, and does not move.
    repeated = judged.filter(F.col("reject_reason").isNull()).join(keys, on, "left_semi")
    refused = judged.filter(F.col("reject_reason").isNotNull()).unionByName(
        repeated.withColumn("reject_reason", _repeated(dataset))
    )
    return refused.select(
        "business_date",
        "source_file_name",
        "source_row_num",
        *dataset.reject_columns,
        "reject_reason",
        F.localtimestamp().alias("rejected_at"),
    )


def _by_key(judged: DataFrame, dataset: Dataset, columns: list[Column]) -> DataFrame:
    """One row per date, validity and key, with its number of rows and some columns of one of them.

    Keys only tell valid rows apart; the invalid rows of a date are one.
    """
    key = dataset.field(dataset.key)
    valid = F.col("reject_reason").isNull()
    return judged.groupBy(
        "business_date",
        valid.alias("is_valid"),
        F.when(valid, F.col(key.parsed)).alias("_key"),
        F.when(valid, number_rest(key.raw)).alias("_rest"),
    ).agg(F.count("*").alias("key_rows"), *[F.first(c).alias(f"_{i}") for i, c in enumerate(columns)])


def reject_inputs(dataset: Dataset) -> list[str]:
    """The columns of judged rows that the rejects are made of."""
    key = dataset.field(dataset.key).parsed
    return ["business_date", "source_file_name", "source_row_num", *dataset.raw_columns, key, "reject_reason"]


def split_counts(judged: DataFrame, dataset: Dataset) -> DataFrame:
    """Per date the rows that a split would accept and reject, without the split: one pass, one row per key moves."""
    accepted = F.col("is_valid") & (F.col("key_rows") == 1)
    return (
        _by_key(judged, dataset, [])
        .groupBy("business_date")
        .agg(
            F.coalesce(F.sum(F.when(accepted, F.col("key_rows"))), F.lit(0)).alias("stage_row_count"),
            F.coalesce(F.sum(F.when(~accepted, F.col("key_rows"))), F.lit(0)).alias("reject_row_count"),
        )
    )


def reason_counts(judged: DataFrame, dataset: Dataset) -> DataFrame:
    """(business_date, reject_reason, row_count) of the rows that a split would reject, without the split.

    One pass, and one narrow row per valid key or reason moves.
    """
    key = dataset.field(dataset.key)
    valid = F.col("reject_reason").isNull()
    rows = judged.groupBy(
        "business_date",
        "reject_reason",
        F.when(valid, F.col(key.parsed)).alias("_key"),
        F.when(valid, number_rest(key.raw)).alias("_rest"),
    ).agg(F.count("*").alias("key_rows"))
    repeated = F.when(F.col("key_rows") > 1, _repeated(dataset))
    return (
        rows.withColumn("reject_reason", F.coalesce("reject_reason", repeated))
        .where(F.col("reject_reason").isNotNull())
        .groupBy("business_date", "reject_reason")
        .agg(F.sum("key_rows").alias("row_count"))
    )


def accepted_values(judged: DataFrame, dataset: Dataset, names: Sequence[str]) -> DataFrame:
    """business_date and some stored columns of the accepted rows, without the split: one pass, narrow rows move."""
    values = _by_key(judged, dataset, [typed(dataset.field(n)) for n in names])
    return values.where(F.col("is_valid") & (F.col("key_rows") == 1)).select(
        "business_date", *[F.col(f"_{i}").alias(n) for i, n in enumerate(names)]
    )


def split_transfers(raw: DataFrame, ref_currency: DataFrame, ref_country: DataFrame) -> Split:
    return split_judged(judge_transfers(raw, ref_currency, ref_country), S.TRANSFERS)


def split_clients(raw: DataFrame) -> Split:
    return split_judged(judge_clients(raw), S.CLIENTS)


def core_rows(stage: DataFrame) -> DataFrame:
    """The curated snapshot: stage without the file line number."""
    return stage.drop("source_row_num")


def typed(field: Field) -> Column:
    """The stored value of a field of an accepted row."""
    if field.kind == "number":
        value = to_number(field.parsed, field.precision, field.scale)
        return value if field.scale or field.precision >= 10 else value.cast("int")
    if field.kind in ("date", "timestamp"):
        return F.col(field.parsed)
    return F.col(field.raw)


def _any(conds: list[Column]) -> Column:
    result = F.lit(False)
    for cond in conds:
        result = result | F.coalesce(cond, F.lit(False))
    return result


def too_wide(dataset: Dataset) -> Column:
    """True for a valid row whose rounded number does not fit its stored type.

    Such a row is no reject; it stops the whole load.
    """
    return _any(
        [~fits(f.parsed, f.precision, f.scale) for f in dataset.fields if f.kind == "number"]
    ) & F.col("reject_reason").isNull()


def unreadable(dataset: Dataset) -> Column:
    """True for a line with a raw value longer than the file contract allows.

    Looks at untrimmed values; such a line stops the whole load.
    """
    return _any([~max_len(f.raw, f.raw_width) for f in dataset.fields])
