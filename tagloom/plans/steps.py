"""The steps of a spec that work on aligned rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession

from tagloom.functions import to_time_column
from tagloom.operators.shape import post_filters, rename_columns, select_columns, sorted_projection, sql_columns, surrogate_id

if TYPE_CHECKING:
    from tagloom.plans.spec import ProcessingSpec


def shaped(aligned: DataFrame, work: ProcessingSpec, kept: Sequence[str] = ()) -> DataFrame:
    """Joined id, sorted columns, time column, filters, selection, renames, SQL columns.

    ``kept`` columns stay, whatever is selected.
    """
    selected = work.select_columns
    if selected:
        selected = (*selected, *(name for name in kept if name not in selected))
    return (
        aligned.transform(surrogate_id, work.key_columns)
        .transform(sorted_projection)
        .transform(to_time_column, work.partition_date)
        .transform(post_filters, work.post_read_filters)
        .transform(select_columns, selected)
        .transform(rename_columns, work.rename_columns)
        .transform(sql_columns, work.sql_transformations)
    )


def check_sql(spark: SparkSession, work: ProcessingSpec) -> None:
    """Analyse the steps on an empty relation of the declared columns; nothing is read or run.

    A name or an expression that does not fit is a ``ValueError`` that says which.
    """
    if work.row_schema is None:
        return
    missing = [key for key in work.key_columns if key not in work.schema.names]
    if missing:
        raise ValueError(f"key columns that the schema does not declare: {missing}")
    try:
        shaped(spark.createDataFrame([], work.row_schema), work).schema
    except (AnalysisException, ParseException) as error:
        raise ValueError(f"the spec's expressions do not fit its columns: {error}") from error
