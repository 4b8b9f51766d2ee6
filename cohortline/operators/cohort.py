"""Cohort operators: the two record tables, eligibility, chunks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.functions import codes
from cohortline.functions.scalars import (
    DATE_FORMATS,
    censored,
    outcome,
    parse_date,
    survival_days,
    years,
)
from cohortline.operators import cleaning
from cohortline.plans.ordering import row_index


def label_outcome(
    df: DataFrame, days: Column, event: Column, label: str = "death_2years", horizon: float = 2.0
) -> DataFrame:
    """Drop rows censored before the horizon and label the rest."""
    followed = df.withColumns({"__years": years(days), "__event": event})
    kept = followed.filter(~censored(F.col("__years"), F.col("__event"), horizon))
    labelled = kept.withColumn(label, outcome(F.col("__years"), F.col("__event"), horizon))
    return labelled.drop("__years", "__event")


def _whole(column: str) -> Column:
    return F.col(column).try_cast("double").cast("int")


def clean_first_table(raw: DataFrame) -> DataFrame:
    """The first record table, from raw text cells to features and label."""
    df = cleaning.clean_names(raw, codes.FIRST_RENAMES)
    df = cleaning.null_tokens(df)
    df = cleaning.recode(
        df, codes.FIRST_STAGE_CODES, cleaning.string_columns(df, ["patient_id"])
    )
    df = df.withColumns({c: _whole(c) for c in codes.FIRST_ORDINALS})
    df = cleaning.fill_sentinel(df, codes.FIRST_ORDINALS)
    df = cleaning.spaces_to_underscores(df, "histology")
    df = cleaning.value_to_null(df, "clinical_n_stage", 4)
    days = F.col("survival_time").try_cast("double")
    df = label_outcome(df, days, _whole("deadstatus_event"))
    return cleaning.drop_columns(df, codes.FIRST_DROPPED)


def clean_second_table(raw: DataFrame, date_formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """The second record table, from raw text cells to features and label."""
    df = cleaning.clean_names(raw, codes.SECOND_RENAMES)
    df = cleaning.drop_columns(df, codes.SECOND_DROPPED_FIRST)
    df = cleaning.null_tokens(df)
    df = cleaning.lower_strings(df)
    df = df.withColumn("pack_years", F.col("pack_years").try_cast("double"))
    df = cleaning.default_where(df, "pack_years", F.col("smoking_status") == "nonsmoker", 0.0)
    df = cleaning.recode(df, codes.SECOND_CODES, cleaning.string_columns(df, ["patient_id"]))
    df = df.withColumns({c: _whole(c) for c in codes.SECOND_ORDINALS})
    df = cleaning.fill_sentinel(df, codes.SECOND_ORDINALS)
    df = cleaning.spaces_to_underscores(df, "histology")
    df = cleaning.flag_either(df, "gene_mutation", "egfr_mutation_status", "kras_mutation_status")
    recorded = F.col("survival_time").try_cast("double") if "survival_time" in df.columns else None
    days = survival_days(
        parse_date("date_of_last_known_alive", date_formats),
        parse_date("ct_date", date_formats),
        _whole("days_between_ct_and_surgery"),
        recorded,
    )
    df = label_outcome(df, days, _whole("survival_status"))
    # The recorded survival is an outcome as well: it must not become a feature.
    return cleaning.drop_columns(df, codes.SECOND_DROPPED_LAST).drop("survival_time")


def unlisted_codes(raw: DataFrame) -> DataFrame:
    """Ordinal cells of the second table that no code covers."""
    df = cleaning.lower_strings(
        cleaning.null_tokens(cleaning.clean_names(raw, codes.SECOND_RENAMES))
    )
    return cleaning.recode_leftovers(df, codes.SECOND_CODES, codes.SECOND_ORDINALS)


def unread_dates(raw: DataFrame, date_formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Dates of the second table that fit none of the formats."""
    df = cleaning.null_tokens(cleaning.clean_names(raw, codes.SECOND_RENAMES))
    return cleaning.unparsed_dates(df, ["date_of_last_known_alive", "ct_date"], date_formats)


def union_common(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both tables with the columns of the first; repeats stay."""
    return first.unionByName(second.select(*first.columns))


def eligible_subjects(
    catalogue: DataFrame,
    subject: str = "Subject ID",
    modality: str = "Modality",
    wanted: str = "SEG",
    single: str = "CT",
) -> DataFrame:
    """Subjects with some ``wanted`` series and exactly one ``single`` series.

    One aggregate instead of a distinct list, a count and a semi join.
    """
    counts = catalogue.filter(F.col(modality).isin(wanted, single)).groupBy(subject).agg(
        F.count_if(F.col(modality) == wanted).alias("__wanted"),
        F.count_if(F.col(modality) == single).alias("__single"),
    )
    return counts.filter((F.col("__wanted") > 0) & (F.col("__single") == 1)).select(subject)


def first_appearance(df: DataFrame, key: str, order: str) -> DataFrame:
    """Distinct keys with the smallest order value of each."""
    return df.groupBy(key).agg(F.min(order).alias("first_seen"))


def assign_chunks(df: DataFrame, key: str, order: str, chunks: int = codes.N_BATCHES) -> DataFrame:
    """Number the distinct keys by first appearance and cut them into chunks.

    A chunk has ``count // chunks + 1`` keys, so trailing chunks may be short
    or stay empty; empty chunks have no rows here.
    """
    placed = row_index(first_appearance(df, key, order), [], ["first_seen", key], "position")
    size = F.floor(F.lit(placed.count()) / chunks) + 1
    return placed.withColumn("chunk", (F.floor(F.col("position") / size) + 1).cast("int")).select(
        key, "position", "chunk"
    )


def common_columns(tables: Mapping[str, DataFrame]) -> list[str]:
    """Columns that every table has, in the order of the first."""
    first, *others = tables.values()
    return [c for c in first.columns if all(c in t.columns for t in others)]
