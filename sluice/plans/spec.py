"""Table registry entries (the declarative cleaning-rule language).

A ``TableSpec`` is one registry entry: which schemas are ready, the ordered
rule steps and their settings, the declared output columns, the join block
and the table dependency.  Validation raises on unknown step names and
unknown custom transforms (the reference skipped them silently, D8).
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from typing import Any, Mapping

# Rule step names of the registry language.
STEP_NAMES = (
    "join", "rename_columns", "convert_one_to_zero", "initcap", "convert_yn_to_boolean", "keep_columns",
    "custom_table_transform", "upper", "convert_zero_to_null", "convert_blank_to_null", "convert_scale_100",
    "convert_scale_1000", "rounding",
)


@dataclass
class TableSpec:
    name: str
    ready: dict[str, bool] = field(default_factory=dict)
    transformation_order: list[str] = field(default_factory=list)
    custom_table_transform: str | None = None
    dependent_table: str | None = None
    partition_by: str | None = None
    keep_columns: dict[str, str] = field(default_factory=dict)
    join: dict[str, Any] | None = None
    rename_columns: dict[str, str] = field(default_factory=dict)
    upper: list[str] = field(default_factory=list)
    initcap: list[str] = field(default_factory=list)
    convert_one_to_zero: list[str] = field(default_factory=list)
    convert_zero_to_null: list[str] = field(default_factory=list)
    convert_blank_to_null: bool = False
    convert_yn_to_boolean: list[str] = field(default_factory=list)
    convert_scale_100: list[str] = field(default_factory=list)
    convert_scale_1000: list[str] = field(default_factory=list)
    rounding: dict[str, int] = field(default_factory=dict)
    filter_deleted: bool = False
    fix_extract_date: list[str] = field(default_factory=list)
    key: str = "id"
    version: str = "updated_at"
    created: str = "created_at"

    @classmethod
    def from_dict(cls, name: str, conf: Mapping[str, Any] | None) -> "TableSpec":
        conf = dict(conf or {})
        known = {f.name for f in fields(cls)}
        unknown = set(conf) - known
        if unknown:
            raise ValueError(f"{name}: unknown registry keys {sorted(unknown)}")
        clean = {k: v for k, v in conf.items() if v is not None}
        spec = cls(name=name, **clean)
        spec.validate()
        return spec

    def configured(self, step: str) -> bool:
        value = getattr(self, step, None)
        return bool(value) if not isinstance(value, bool) else value

    def validate(self, custom_names=None) -> None:
        bad = [s for s in self.transformation_order if s not in STEP_NAMES]
        if bad:
            raise ValueError(f"{self.name}: unknown rule steps {bad}")
        if custom_names is not None and self.custom_table_transform and self.custom_table_transform not in custom_names:
            raise ValueError(f"{self.name}: unknown custom transform {self.custom_table_transform!r}")
        if self.join is not None:
            missing = {"with_table", "left", "right"} - set(self.join)
            if missing:
                raise ValueError(f"{self.name}: join block lacks {sorted(missing)}")


def load_registry(conf: Mapping[str, Mapping[str, Any]]) -> dict[str, TableSpec]:
    """Parse a whole registry ``{table: {...}}`` (e.g. loaded from YAML)."""
    return {name: TableSpec.from_dict(name, c) for name, c in conf.items()}
