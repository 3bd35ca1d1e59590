"""What an analyst sees of a record: harm tag, detail label, preview, search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that mark a payload as harmful, in any case (fixed values).
HARM_WORDS = ("error", "fail", "denied", "exception", "block", "fault")


def harm_tag(payload: Column) -> Column:
    return F.when(F.lower(payload).rlike("|".join(HARM_WORDS)), "High").otherwise("Low")


def detail_label(payload: Column, type_uid: Column) -> Column:
    event_id = F.regexp_extract(payload, r'(?i)"EventID"\s*:\s*(\d+)', 1)
    return F.coalesce(
        F.when(event_id != "", F.concat(F.lit("EventID: "), event_id)),
        F.concat(F.lit("UID: "), type_uid.cast("string")),
        F.lit("N/A"),
    )


def preview(payload: Column, n: int = 50) -> Column:
    return F.concat(F.left(payload, F.lit(n)), F.lit("..."))


def search(df: DataFrame, text: str, columns: list[str] | None = None) -> DataFrame:
    """Rows whose shown columns contain the text, in any case."""
    shown = F.concat_ws(" ", *[F.col(c).cast("string") for c in columns or df.columns])
    return df.filter(F.lower(shown).contains(text.lower()))
