"""Row rules on a stream. They keep no state, so a stream needs no watermark and no shuffle."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame

from rowproof.config import DatasetConfig
from rowproof.plans.validation import VERDICT, Flags, add_address_checks, add_row_checks


def flag_stream(
    stream: DataFrame,
    config: DatasetConfig,
    zip_ref: DataFrame | None = None,
    *,
    area_codes: Collection[str] | None = None,
    street_types: Sequence[str] | None = None,
) -> DataFrame:
    """Address, phone, e-mail, web and name rules with their verdict on arriving rows.

    Duplicates and outliers need the whole table and are left to `plans.validation.validate`.
    """
    if config.addresses and zip_ref is None:
        raise ValueError("address rules need a ZIP reference table")
    flags = Flags()
    if config.addresses:
        stream = add_address_checks(stream, config, flags, zip_ref, street_types)
    stream = add_row_checks(stream, config, flags, area_codes)
    return stream.withColumn(VERDICT, flags.verdict())
