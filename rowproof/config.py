"""Dataset configuration. Read on the driver only; it never travels with the rows."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field


def _listed(raw) -> tuple[str, ...]:
    """A configured list; a missing list and a list that holds only null both mean "off"."""
    if raw is None:
        return ()
    if isinstance(raw, str):
        return (raw,)
    return tuple(item for item in raw if item is not None)


def _single(raw) -> str | None:
    items = _listed(raw)
    return items[0] if items else None


@dataclass(frozen=True)
class AddressConfig:
    """Column names of one address group; `None` means the table has no such part."""

    root: str
    address1: str
    city: str
    state: str
    postal_code: str
    full_address: str | None = None
    address2: str | None = None
    address3: str | None = None
    country: str | None = None

    @classmethod
    def from_dict(cls, raw: Mapping) -> "AddressConfig":
        parts = dict(raw)
        return cls(root=parts.pop("address_root_name"), **parts)


@dataclass(frozen=True)
class DatasetConfig:
    table: str
    primary_key: tuple[str, ...]
    schema: str | None = None
    reference_fields: tuple[str, ...] = ()
    default_country_field: str | None = None
    default_country_code: str = "US"
    duplicates: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    addresses: Mapping[str, AddressConfig] = field(default_factory=dict)
    phone: tuple[str, ...] = ()
    email: tuple[str, ...] = ()
    url: tuple[str, ...] = ()
    name: tuple[str, ...] = ()
    z_outliers: tuple[str, ...] = ()
    iqr_outliers: tuple[str, ...] = ()
    date_outliers: tuple[str, ...] = ()
    exceptions: tuple[str, ...] = ()

    @classmethod
    def from_dict(cls, raw: Mapping) -> "DatasetConfig":
        """Build from the nested mapping shape: lists of column names, `[None]` for "off"."""
        address = raw.get("address") or {}
        groups = address.get("addresses") or {}
        return cls(
            table=_single(raw.get("db_table")) or "",
            primary_key=_listed(raw.get("db_primary_key")),
            schema=_single(raw.get("db_schema")),
            reference_fields=_listed(raw.get("reference_fields")),
            default_country_field=_single(raw.get("default_country_field")),
            default_country_code=_single(raw.get("default_country_code")) or "US",
            duplicates=_listed(raw.get("duplicates")),
            required=_listed(raw.get("isNull")),
            addresses=(
                {key: AddressConfig.from_dict(group) for key, group in groups.items()}
                if address.get("hasAddress")
                else {}
            ),
            phone=_listed(raw.get("phone")),
            email=_listed(raw.get("email")),
            url=_listed(raw.get("url")),
            name=_listed(raw.get("name")),
            z_outliers=_listed(raw.get("z_num_outliers")),
            iqr_outliers=_listed(raw.get("iq_num_outliers")),
            date_outliers=_listed(raw.get("date_outliers")),
            exceptions=_listed(raw.get("exception_from_row_validation")),
        )

    @property
    def has_key(self) -> bool:
        """Reports need exactly one real key column; other datasets are skipped."""
        return len(self.primary_key) == 1

    @property
    def key(self) -> str:
        if not self.has_key:
            raise ValueError(f"dataset {self.table!r} needs exactly one key column")
        return self.primary_key[0]

    @property
    def base_fields(self) -> list[str]:
        return [self.key, *self.reference_fields]

    @property
    def numeric_columns(self) -> list[str]:
        return list(dict.fromkeys([*self.z_outliers, *self.iqr_outliers]))

    @property
    def country_columns(self) -> list[str]:
        """Columns that hold country codes, where the text NA is Namibia and not a null token."""
        groups = [a.country for a in self.addresses.values() if a.country]
        default = [self.default_country_field] if self.default_country_field else []
        return list(dict.fromkeys([*default, *groups]))


def _plain_name(name: str) -> str:
    base = name.replace("\\", "/").rsplit("/", 1)[-1].lower()
    return base.removesuffix(".csv").replace("_", "")


def resolve_config(
    name: str, registry: Mapping[str, DatasetConfig], names: Mapping[str, str] | None = None
) -> DatasetConfig | None:
    """Find the dataset for a file or table name, ignoring case, underscores and `.csv`.

    `names` maps source names to dataset names, as found where sources are called otherwise than their
    tables; it is asked first, and a name that it lacks stands for itself.
    """
    wanted = _plain_name(name)
    for source, target in (names or {}).items():
        if _plain_name(source) == wanted:
            wanted = _plain_name(target)
            break
    return next((c for key, c in registry.items() if _plain_name(key) == wanted), None)


def load_registry(text: str) -> dict[str, DatasetConfig]:
    """Registry from JSON text: one entry per dataset name."""
    return {name: DatasetConfig.from_dict(raw) for name, raw in json.loads(text).items()}


def existing(columns: Iterable[str | None], available: Iterable[str]) -> list[str]:
    """The wanted columns that exist, in the order given, each once."""
    present = set(available)
    return list(dict.fromkeys(c for c in columns if c is not None and c in present))
