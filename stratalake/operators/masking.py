"""Classification-driven masking of personal columns, as one projection over the frame."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import masks
from stratalake.functions.keys import named
from stratalake.operators.joins import reconcile
from stratalake.operators.nested import changed_rows

Rule = Callable[[Column, T.DataType, Column, str], Column]

# Which classifications call for which mask; the first rule that matches applies.
RULES: tuple[tuple[str, frozenset[str], Rule], ...] = (
    ("number", frozenset({"NI Number"}), lambda c, t, s, f: masks.fake_number(c, s, f)),
    (
        "email",
        frozenset({"MICROSOFT.PERSONAL.EMAIL", "Email Address", "Email Address Column Name"}),
        lambda c, t, s, f: masks.hashed_email(c),
    ),
    (
        "name",
        frozenset(
            {"MICROSOFT.PERSONAL.NAME", "First Name", "Last Name", "Names Column Name", "All Full Names"}
        ),
        lambda c, t, s, f: masks.redacted(c),
    ),
    (
        "birth_date",
        frozenset({"Birth Date", "Date of Birth"}),
        lambda c, t, s, f: masks.fake_birth_date(c, s, f),
    ),
    (
        "age",
        frozenset({"Person's Age", "Employee Age"}),
        lambda c, t, s, f: masks.fake_int(c, s, masks.AGE_RANGE, f),
    ),
    ("salary", frozenset({"Annual Salary"}), lambda c, t, s, f: masks.fake_int(c, s, masks.SALARY_RANGE, f)),
    (
        "address",
        frozenset(
            {
                "Address Line 1",
                "Address Line 2",
                "Street Address",
                "Postcode",
                "UK Postcode",
                "All Physical Addresses",
                "MICROSOFT.PERSONAL.PHYSICALADDRESS",
            }
        ),
        lambda c, t, s, f: masks.redacted_address(c, t),
    ),
)


@dataclass(frozen=True)
class MaskingPolicy:
    """Which classifications may be masked, what seeds the masks, and where masking applies at all."""

    allowlist: frozenset[str] | None = None
    seed_column: str | None = None
    entity_seeds: Mapping[str, str] = field(default_factory=dict)
    flavour: str = "murmur"

    def seed_for(self, entity: str | None) -> str | None:
        return self.entity_seeds.get(entity or "", self.seed_column)

    @staticmethod
    def from_mapping(raw: Mapping[str, object]) -> "MaskingPolicy":
        """Policy from parsed configuration: ``classification_allowlist``, ``seed_column``, ``entity_seed_columns``."""
        allow = raw.get("classification_allowlist")
        return MaskingPolicy(
            allowlist=frozenset(allow) if allow else None,  # type: ignore[arg-type]
            seed_column=raw.get("seed_column"),  # type: ignore[arg-type]
            entity_seeds=dict(raw.get("entity_seed_columns") or {}),  # type: ignore[call-overload]
        )


# Names of environments whose data is masked. Any other name counts as production.
MASKED_ENVIRONMENTS = frozenset({"DEV", "TEST", "BUILD"})


def masks_apply(environment: str | None) -> bool:
    """Masking is for the environments named as such; an unknown one is treated as production."""
    return (environment or "").strip().upper() in MASKED_ENVIRONMENTS


def match_name(name: str | None) -> str:
    """Name for matching: letters and digits only, lower case, one common misspelling put right."""
    return re.sub(r"[^a-z0-9]", "", (name or "").strip().lower()).replace("adress", "address")


@dataclass(frozen=True)
class Decision:
    column: str
    rule: str | None
    reason: str | None


def decide(
    columns: Sequence[str], classified: Iterable[Mapping[str, object]], allowlist: Iterable[str] | None = None
) -> list[Decision]:
    """For every classified column: the rule that will mask it, or why it is left alone."""
    by_name = {match_name(c): c for c in columns}
    allowed = frozenset(allowlist) if allowlist else None
    out = []
    for item in classified:
        raw = str(item.get("column_name") or "")
        actual = by_name.get(match_name(raw)) or by_name.get(match_name(raw.rsplit(".", 1)[-1]) if "." in raw else "")
        if not actual:
            out.append(Decision(raw, None, "not_in_dataframe"))
            continue
        classes = set(item.get("classifications") or ())  # type: ignore[call-overload]
        if allowed is not None:
            classes &= allowed
        if not classes:
            out.append(Decision(actual, None, "no_allowlisted_classification"))
            continue
        rule = next((name for name, wanted, _ in RULES if classes & wanted), None)
        out.append(Decision(actual, rule, None if rule else "no_matching_strategy"))
    return out


def mask_columns(
    df: DataFrame, rules: Mapping[str, str], seed_column: str | None = None, flavour: str = "murmur"
) -> DataFrame:
    """Apply named rules to columns. The seed is taken from the unmasked row."""
    seed = masks.seed_for(df.columns, seed_column)
    by_rule = {name: fn for name, _, fn in RULES}
    return df.withColumns(
        {c: by_rule[r](named(c), df.schema[c].dataType, seed, flavour) for c, r in rules.items()}
    )


def mask_classified(
    df: DataFrame,
    classified: Iterable[Mapping[str, object]],
    policy: MaskingPolicy = MaskingPolicy(),
    entity: str | None = None,
) -> DataFrame:
    """Mask what the classification list asks for and the policy allows. Errors are raised, never swallowed."""
    chosen: dict[str, str] = {}
    for d in decide(df.columns, classified, policy.allowlist):
        if d.rule:
            chosen.setdefault(d.column, d.rule)
    return mask_columns(df, chosen, policy.seed_for(entity), policy.flavour)


def mask_for_environment(
    df: DataFrame,
    classified: Iterable[Mapping[str, object]],
    environment: str | None,
    policy: MaskingPolicy = MaskingPolicy(),
    entity: str | None = None,
) -> DataFrame:
    return mask_classified(df, classified, policy, entity) if masks_apply(environment) else df


def masking_summary(
    df: DataFrame,
    classified: Sequence[Mapping[str, object]],
    policy: MaskingPolicy = MaskingPolicy(),
    entity: str | None = None,
) -> DataFrame:
    """One row: masked columns, skipped columns with the reason, and the number of rows that changed."""
    found = decide(df.columns, classified, policy.allowlist)
    masked = sorted({d.column for d in found if d.rule})
    before = df.withColumns({f"_before_{c}": named(c) for c in masked})
    after = mask_columns(
        before, {d.column: d.rule for d in found if d.rule}, policy.seed_for(entity), policy.flavour
    )
    counted = changed_rows({f"_before_{c}": c for c in masked}, after, "changed_rows")
    skipped = "; ".join(sorted(f"{d.column}: {d.reason}" for d in found if not d.rule))
    return counted.select(F.lit(", ".join(masked)).alias("masked"), F.lit(skipped).alias("skipped"), "changed_rows")


def remask(
    standardised: DataFrame,
    raw: DataFrame,
    keys: Sequence[str],
    rules: Mapping[str, str],
    seed_column: str | None = None,
    flavour: str = "murmur",
) -> DataFrame:
    """Masked history from raw values: the listed columns come back by key, then today's rules apply."""
    return mask_columns(reconcile(standardised, raw, keys, list(rules)), rules, seed_column, flavour)


def masked_in_place(df: DataFrame) -> DataFrame:
    """Rows in which any text column still looks masked in the older style."""
    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    hit = F.lit(False)
    for c in text_cols:
        hit = hit | F.coalesce(masks.looks_masked_in_place(named(c)), F.lit(False))
    return df.filter(hit)
