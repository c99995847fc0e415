"""Validation run: one flagged table, and the reports taken from it."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowproof.config import DatasetConfig, existing
from rowproof.functions.contact import email_check, email_valid, name_check, website_check
from rowproof.functions.phone import phone_cleaning
from rowproof.operators.address import OUTPUTS, with_clean_address
from rowproof.operators.columns import nan_to_null, ref, spread
from rowproof.operators.duplicates import duplicates_by_column, exact_duplicates
from rowproof.operators.frequency import frequency
from rowproof.operators.outliers import date_flags, iqr_flags, z_flags
from rowproof.operators.project import default_country, null_rows, report_columns
from rowproof.operators.quantiles import MAX_VALUES_IN_TASK
from rowproof.operators.ziplookup import zip_records
from rowproof.sources.sinks import DETAIL_SEPARATOR, SUMMARY_SEPARATOR, write_report
from rowproof.sources.staging import staged

VERDICT = "row_is_valid"
DEFAULT_COUNTRY = "DCountry"


@dataclass
class Flags:
    """Columns that the rules add, by rule family, and what counts for the verdict."""

    details: dict[str, list[str]] = field(default_factory=dict)
    must_hold: list[str] = field(default_factory=list)
    must_not_hold: list[str] = field(default_factory=list)
    checks: list[str] = field(default_factory=list)
    families: dict[str, list[str]] = field(default_factory=dict)

    def add(self, family: str, columns: Sequence[str], check: str, counts: bool, bad: bool = False):
        self.details.setdefault(family, []).extend(columns)
        self.checks.append(check)
        self.families.setdefault(family, []).append(check)
        if counts:
            (self.must_not_hold if bad else self.must_hold).append(check)

    def verdict(self) -> Column:
        rules = [ref(c) for c in self.must_hold] + [~ref(c) for c in self.must_not_hold]
        return reduce(lambda a, b: a & b, rules, F.lit(True))


def add_row_checks(
    df: DataFrame, config: DatasetConfig, flags: Flags, area_codes: Collection[str] | None = None
) -> DataFrame:
    """Phone, e-mail, web and name columns in one projection; absent columns are skipped."""
    country = default_country(df, config.default_country_field, config.default_country_code)
    new: dict[str, Column] = {}
    if config.phone and config.default_country_field not in df.columns:
        new[DEFAULT_COUNTRY] = F.lit(config.default_country_code)
        shown_country = DEFAULT_COUNTRY
    else:
        shown_country = config.default_country_field
    for c in existing(config.phone, df.columns):
        result = phone_cleaning(c, country, area_codes)
        names = [f"{c}_is_valid", f"{c}_formatted", f"{c}_ext_formatted"]
        new |= {n: result[part] for n, part in zip(names, ("valid", "formatted", "ext"))}
        flags.add("phone", [c, shown_country, *names], names[0], c not in config.exceptions)
    for c in existing(config.email, df.columns):
        names = [f"{c}_normalized", f"{c}_check"]
        new |= {names[0]: email_valid(c), names[1]: email_check(c)}
        flags.add("email", [c, *names], names[1], c not in config.exceptions)
    for c in existing(config.url, df.columns):
        new[f"{c}_is_valid"] = website_check(c)
        flags.add("url", [c, f"{c}_is_valid"], f"{c}_is_valid", c not in config.exceptions)
    for c in existing(config.name, df.columns):
        new[f"{c}_check"] = name_check(c)
        flags.add("name", [c, f"{c}_check"], f"{c}_check", c not in config.exceptions)
    return df.withColumns(new) if new else df


def add_address_checks(
    df: DataFrame,
    config: DatasetConfig,
    flags: Flags,
    zip_ref: DataFrame,
    street_types: Sequence[str] | None = None,
) -> DataFrame:
    """The nine output columns of every address group, groups in key order; rows are dealt to tasks once."""
    df = spread(df)
    for key in sorted(config.addresses):
        group = config.addresses[key]
        df = with_clean_address(
            df,
            group.root,
            zip_ref,
            full_address=group.full_address,
            address1=group.address1,
            address2=group.address2,
            address3=group.address3,
            city=group.city,
            state=group.state,
            postal_code=group.postal_code,
            country=group.country,
            street_types=street_types,
        )
        inputs = [
            group.full_address, group.address1, group.address2, group.address3, group.city,
            group.state, group.postal_code, group.country,
        ]
        outputs = [f"{group.root}_{name}" for name in OUTPUTS]
        counts = key not in config.exceptions
        columns = [c for c in inputs if c] + outputs
        flags.add(f"address_{group.root}", columns, outputs[0], counts)
    return df


def add_outlier_checks(
    df: DataFrame,
    source: DataFrame,
    config: DatasetConfig,
    flags: Flags,
    max_values_in_task: int = MAX_VALUES_IN_TASK,
) -> DataFrame:
    """Outlier flags of `df` with statistics of `source`, the table before any added columns."""
    z = existing(config.z_outliers, source.columns)
    iqr = existing(config.iqr_outliers, source.columns)
    dates = existing(config.date_outliers, source.columns)
    made = {
        "z_outliers": (z, z_flags(source, z)),
        "iqr_outliers": (iqr, iqr_flags(source, iqr, max_values_in_task)),
        "date_outliers": (dates, date_flags(source, dates, max_values_in_task) if dates else {}),
    }
    new: dict[str, Column] = {}
    for family, (columns, values) in made.items():
        for c, flag in zip(columns, values):
            flags.add(family, [c, flag], flag, c not in config.exceptions, bad=True)
        new |= values
    return df.withColumns(new) if new else df


def flag_rows(
    df: DataFrame,
    config: DatasetConfig,
    zip_ref: DataFrame | None = None,
    *,
    area_codes: Collection[str] | None = None,
    street_types: Sequence[str] | None = None,
    max_values_in_task: int = MAX_VALUES_IN_TASK,
) -> tuple[DataFrame, Flags]:
    """All rule columns and the verdict, as one plan; NaN is null. Only address rules of many rows shuffle them, once."""
    if config.addresses and zip_ref is None:
        raise ValueError("address rules need a ZIP reference table")
    df = nan_to_null(df)
    flags = Flags()
    out = df
    if config.addresses:
        out = add_address_checks(out, config, flags, zip_ref, street_types)
    out = add_row_checks(out, config, flags, area_codes)
    out = add_outlier_checks(out, df, config, flags, max_values_in_task)
    return out.withColumn(VERDICT, flags.verdict()), flags


class Reports(Mapping):
    """Reports by name. A report's plan is built when it is asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders

    def __getitem__(self, name: str) -> DataFrame:
        return self._builders[name]()

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def validate(
    df: DataFrame,
    config: DatasetConfig,
    zip_ref: DataFrame | None = None,
    *,
    stage: bool = True,
    area_codes: Collection[str] | None = None,
    street_types: Sequence[str] | None = None,
    max_values_in_task: int = MAX_VALUES_IN_TASK,
) -> Reports:
    """All reports of a dataset by name.

    With `stage` the flagged table is written once to the shared folder and every report reads
    its own columns from there; without it each report is a plan over the input.
    """
    if stage and zip_ref is not None and config.addresses:
        # Reduced and written once, its size is known: all address groups can then broadcast it.
        zip_ref = staged(zip_records(zip_ref))
    flagged, flags = flag_rows(
        df,
        config,
        zip_ref,
        area_codes=area_codes,
        street_types=street_types,
        max_values_in_task=max_values_in_task,
    )
    if stage:
        flagged = staged(flagged)
    builders: dict[str, Callable[[], DataFrame]] = {}

    repeated = existing(config.duplicates, df.columns)
    if repeated:
        builders["exact_duplicates"] = lambda: exact_duplicates(
            df, repeated, config.key, config.table
        )
        for c in repeated:
            builders[f"duplicates_{c}"] = partial(duplicates_by_column, df, c, config.key)
    if config.required:
        needed = existing([*config.base_fields, *config.required], df.columns)
        builders["null_required_fields"] = lambda: null_rows(df, needed)

    roots = [config.addresses[key].root for key in sorted(config.addresses)]
    if roots:
        builders["duplicate_addresses"] = lambda: exact_duplicates(
            flagged, [f"{root}_full_address" for root in roots], config.key, config.table
        )
    for family, columns in flags.details.items():
        builders[family] = partial(
            report_columns, flagged, [*config.base_fields, VERDICT], columns
        )

    def frequencies(columns: Sequence[str]) -> DataFrame:
        return frequency(_printable(flagged), config.table, existing(columns, flagged.columns))

    builders["validation_summary"] = lambda: flagged
    messages = [f"{root}_addr_error_messg" for root in roots]
    if flags.checks:
        builders["check_frequency"] = lambda: frequencies([*flags.checks, *messages])
    for family, checks in flags.families.items():
        # An address group shows its messages beside its check.
        texts = [m for m in messages if family == f"address_{m.removesuffix('_addr_error_messg')}"]
        builders[f"{family}_frequency"] = partial(frequencies, [*checks, *texts])
    builders["row_frequency"] = lambda: frequencies([VERDICT])
    shown = [c for columns in flags.details.values() for c in columns]
    builders["column_frequency"] = lambda: frequencies([*config.base_fields, VERDICT, *shown])
    return Reports(builders)


def _printable(df: DataFrame) -> DataFrame:
    """Message lists as one text, as the reports show them."""
    lists = {
        c: F.array_join(F.col(c), ",") for c in df.columns if c.endswith("_addr_error_messg")
    }
    return df.withColumns(lists) if lists else df


def write_reports(reports: Mapping[str, DataFrame], folder: str, name: str) -> None:
    """Each report as a delimited directory; rule details use `|`, the others a comma."""
    commas = {
        "exact_duplicates", "null_required_fields", "duplicate_addresses", "validation_summary",
        "check_frequency", "row_frequency", "column_frequency",
    }
    for report, df in reports.items():
        plain = report in commas or report.endswith("_frequency") or report.startswith("duplicates_")
        sep = SUMMARY_SEPARATOR if plain else DETAIL_SEPARATOR
        write_report(df, f"{folder.rstrip('/')}/{report}_{name}", sep)
