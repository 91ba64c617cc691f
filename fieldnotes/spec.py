"""Declared roles of the columns of a wide observation table.

A table is positional: every column has a role, and the role decides how a
raw text cell is read (see ``fieldnotes.functions.cells``):

* ``key``        -- row identifier, kept as untouched text;
* ``id_cols``    -- text holding a number; the first run of digits is read;
* ``discrete``   -- category names, coded by a dictionary;
* ``excluded``   -- never read (treated as missing, and not selected);
* everything else is continuous, the label included.

The spec is plain data, so it can be saved next to a model as JSON.
"""

from __future__ import annotations

import itertools
import json
import re
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import types as T


@dataclass(frozen=True)
class FeatureSpec:
    columns: tuple[str, ...]
    label: str
    key: str | None = None
    # columns passed through untouched and never features (e.g. a numeric
    # row key next to the text key)
    carry: tuple[str, ...] = ()
    id_cols: tuple[str, ...] = ()
    discrete: tuple[str, ...] = ()
    excluded: tuple[str, ...] = ()
    missing_token: str = "?"
    null_token: str = "X"
    # value a null-token cell takes; the label's "X" therefore counts as
    # "not seen"
    null_token_value: float = 0.0
    # chosen model inputs (empty = all continuous and discrete features)
    features: tuple[str, ...] = ()
    # per-feature fill for missing cells when vectors are built (default -1)
    replace: dict[str, float] = field(default_factory=dict)

    def __post_init__(self):
        cols = tuple(self.columns)
        object.__setattr__(self, "columns", cols)
        for name in ("carry", "id_cols", "discrete", "excluded", "features"):
            object.__setattr__(self, name, tuple(getattr(self, name)))
        known = set(cols)
        for name in ("carry", "id_cols", "discrete", "excluded", "features"):
            unknown = [c for c in getattr(self, name) if c not in known]
            if unknown:
                raise ValueError(f"{name}: unknown columns {unknown}")
        if self.label not in known:
            raise ValueError(f"label {self.label!r} is not a column")
        if self.key is not None and self.key not in known:
            raise ValueError(f"key {self.key!r} is not a column")
        if self.label in self.discrete or self.label in self.excluded:
            raise ValueError("the label must be a continuous column")

    # -- role predicates (evaluated at plan time) ------------------------
    def is_excluded(self, c: str) -> bool:
        return c in self.excluded

    def is_carried(self, c: str) -> bool:
        return c in self.carry

    def is_id(self, c: str) -> bool:
        return c in self.id_cols and c not in self.excluded

    def is_discrete(self, c: str) -> bool:
        return c in self.discrete and c not in self.excluded and c not in self.carry

    def is_continuous(self, c: str) -> bool:
        return (c not in self.excluded and c not in self.discrete
                and c not in self.id_cols and c != self.key and c not in self.carry)

    @property
    def continuous(self) -> tuple[str, ...]:
        """Continuous columns in file order; the label is one of them."""
        return tuple(c for c in self.columns if self.is_continuous(c))

    @property
    def discrete_features(self) -> tuple[str, ...]:
        return tuple(c for c in self.columns if self.is_discrete(c))

    @property
    def id_features(self) -> tuple[str, ...]:
        return tuple(c for c in self.columns if self.is_id(c))

    @property
    def predictors(self) -> tuple[str, ...]:
        """Model inputs in file order, without the label."""
        chosen = set(self.features) if self.features else None
        out = []
        for c in self.columns:
            if c == self.label or not (self.is_continuous(c) or self.is_discrete(c)):
                continue
            if chosen is None or c in chosen:
                out.append(c)
        return tuple(out)

    def raw_schema(self) -> T.StructType:
        """All-text schema for reading the file (no inference)."""
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.columns])

    def with_features(self, features) -> "FeatureSpec":
        return replace(self, features=tuple(features))

    # -- persistence -------------------------------------------------------
    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> "FeatureSpec":
        data = json.loads(text)
        return cls(**data)

    @classmethod
    def from_header(cls, header: list[str], **roles) -> "FeatureSpec":
        """Spec for a file whose header gives the column names; names are
        cleaned first, so roles are given in cleaned form."""
        return cls(columns=tuple(clean_names(header)), **roles)


_STEM = re.compile(r"^(.*?)(\d*)$", re.DOTALL)


def clean_names(names) -> list[str]:
    """Upper case, ``_`` for spaces, and no name twice.

    A name that is taken becomes its stem (the name without the digits at its
    end) with the next number above its own that is free; without digits, the
    count starts at 1. So ``X, X, X`` gives ``X, X1, X2``, and inner digits
    stay (``NLCD2006_FS``). ``last`` keeps where the count of a stem and number
    got to, so a name repeated k times costs k steps.
    """
    taken: dict[str, None] = {}
    last: dict[tuple[str, int], int] = {}
    for raw in names:
        name = str(raw).upper().replace(" ", "_")
        if name in taken:
            stem, digits = _STEM.match(name).groups()
            start = (stem, int(digits or 0))
            free = next(n for n in itertools.count(last.get(start, start[1]) + 1) if f"{stem}{n}" not in taken)
            last[start] = free
            name = f"{stem}{free}"
        taken[name] = None
    return list(taken)


# --------------------------------------------------------------------------
# Roles of the 1,657-column checklist layout the two jobs were
# built for (column names after clean_names). They must stay as they are for
# the trained feature list to mean the same columns.
CHECKLIST_LABEL = "AGELAIUS_PHOENICEUS"
CHECKLIST_KEY = "SAMPLING_EVENT_ID"
CHECKLIST_ID_COLS = (
    "SAMPLING_EVENT_ID", "LOC_ID", "OBSERVER_ID", "GROUP_ID",
    "SAMPLING_EVENT_ID1", "LOC_ID1", "SAMPLING_EVENT_ID2", "LOC_ID2",
)
CHECKLIST_DISCRETE = (
    "COUNTRY", "STATE_PROVINCE", "COUNTY", "COUNT_TYPE",
    "BCR", "BAILEY_ECOREGION", "OMERNIK_L3_ECOREGION", "SUBNATIONAL2_CODE",
)
CHECKLIST_EXCLUDED = (
    "SAMPLING_EVENT_ID", "LOC_ID", "COUNTRY", "STATE_PROVINCE", "COUNTY",
    "COUNT_TYPE", "OBSERVER_ID", "GROUP_ID", "PRIMARY_CHECKLIST_FLAG",
    "SAMPLING_EVENT_ID1", "LOC_ID1", "SAMPLING_EVENT_ID2", "BCR",
    "BAILEY_ECOREGION", "OMERNIK_L3_ECOREGION", "LOC_ID2", "SUBNATIONAL2_CODE",
)
CHECKLIST_DEFAULT_FEATURES = (
    "TURDUS_MIGRATORIUS", "ARDEA_HERODIAS", "MONTH", "MELOSPIZA_MELODIA",
    "MOLOTHRUS_ATER", "CAUS_TEMP_MAX", "NLCD2006_FS_C82_7500_LPI",
    "ANAS_PLATYRHYNCHOS", "STURNUS_VULGARIS", "CAUS_TEMP_MIN06",
    "DIST_FROM_WET_VEG_FRESH", "TROGLODYTES_HIEMALIS", "EFFORT_HRS",
    "NLCD2011_FS_C95_75_LPI",
)
# --------------------------------------------------------------------------


def checklist_spec(header: list[str], features=CHECKLIST_DEFAULT_FEATURES,
                   excluded=CHECKLIST_EXCLUDED) -> FeatureSpec:
    """Spec of the checklist layout from a file header.

    ``excluded`` defaults to the layout's list, which also covers every id
    and discrete column; pass a shorter list to use those columns.
    """
    names = clean_names(header)
    present = set(names)
    absent = [c for c in features if c not in present]
    if absent:
        raise ValueError(f"features that the file doesn't have: {absent}")
    return FeatureSpec(
        columns=tuple(names),
        label=CHECKLIST_LABEL,
        key=CHECKLIST_KEY if CHECKLIST_KEY in present else None,
        id_cols=tuple(c for c in CHECKLIST_ID_COLS if c in present),
        discrete=tuple(c for c in CHECKLIST_DISCRETE if c in present),
        excluded=tuple(c for c in excluded if c in present),
        features=tuple(features),
    )


def spec_for_header(spec: FeatureSpec, header: list[str]) -> FeatureSpec:
    """The same roles on a file with this header.

    Chosen features, the key, and id or discrete columns must be there;
    excluded and carried ones may be absent. An absent label is appended as a
    last column (an unlabeled file: it then reads as absent).
    """
    roles = {spec.label, spec.key, *spec.id_cols, *spec.discrete, *spec.carry} - {None}
    raw = [str(h) for h in header]
    cleaned = list(clean_names(header))
    # the spec may name columns as the file does, or in cleaned form
    names = raw if len(roles & set(raw)) >= len(roles & set(cleaned)) else cleaned
    if spec.label not in names:
        names.append(spec.label)
    present = set(names)
    needed = {*spec.features, *spec.id_cols, *spec.discrete, spec.key} - {None} - set(spec.excluded)
    absent = sorted(needed - present)
    if absent:
        raise ValueError(f"columns that the file doesn't have: {absent}")
    keep = lambda cols: tuple(c for c in cols if c in present)
    return replace(spec, columns=tuple(names), carry=keep(spec.carry),
                   id_cols=keep(spec.id_cols), discrete=keep(spec.discrete),
                   excluded=keep(spec.excluded), features=keep(spec.features),
                   key=spec.key if spec.key in present else None)
