"""Per-column quality rules evaluated in one pass.

A rule set becomes an ordered list of :class:`Check` objects. ``outcomes`` walks the
list once and keeps one row per input row: the columns after all rewrites, a bit per
failed check, and the older value of a column only where a check rewrites it.
Survivors, rejects and audit counts are readings of that frame, instead of one scan per
rule; only failing rows are unfolded, one reject per failed check with the row as that
check saw it.

A check that is not told to reject still reports: the row appears among the
rejects *and* stays among the survivors.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import TEXT_FORMAT, as_col, date_part_text, parse_date_exact, reformat_date
from martloom.functions.text import guarded_cast, is_blank, lead_minus, round_half_up_text, strip_chars
from martloom.session import stage

ALIVE = "_alive"
FAILED = "_failed"
REASON = "Rejection_Reason"
RAGGED = "_ragged"  # set by the reader where a record has too few or too many fields
MAX_CHECKS = 63  # bits of one long

# The reasons written to the reject stream.
LENGTH_REASON = "Some Columns of :'{rules}' exceeds max length"
DECIMAL_REASON = "Decimal columns {rules} not in proper format"
DATE_REASON = "Date fields: {rules} not in proper format"
INTEGER_REASON = "Integer fields not in proper format for column: {rules}"
HARMONISE_REASON = "Date harmonization failed for column : {rules}"
NOT_NULL_REASON = "Null values found in columns: {rules}"
WIDTH_REASON = "Wrong number of fields"
# Texts that count as an absent date.
ABSENT_DATES = ("", "0", "00000000")


@dataclass(frozen=True)
class LengthRule:
    column: str
    size: int
    text: str


@dataclass(frozen=True)
class DecimalRule:
    column: str
    precision: int
    scale: int
    text: str


@dataclass(frozen=True)
class DateRule:
    column: str
    fmt: str
    nullable: bool
    text: str


@dataclass(frozen=True)
class IntegerRule:
    column: str
    text: str


@dataclass(frozen=True)
class RuleSet:
    length: tuple[LengthRule, ...] = ()
    decimal: tuple[DecimalRule, ...] = ()
    date: tuple[DateRule, ...] = ()
    integer: tuple[IntegerRule, ...] = ()


@dataclass(frozen=True)
class Check:
    """One step of the chain.

    ``ok`` is the pass condition on the row as it stands; ``rewrite`` replaces
    columns afterwards, for failed rows too when they are kept. ``keep`` is a
    second condition for staying, tested on the rewritten row (default ``ok``).
    ``attach`` adds helper columns first; ``helpers`` names them for removal.
    """

    reason: str
    ok: Column
    reject: bool = False
    rewrite: Mapping[str, Column] = field(default_factory=dict)
    keep: Column | None = None
    attach: Callable[[DataFrame], DataFrame] | None = None
    helpers: tuple[str, ...] = ()


def column_name(text: str) -> str:
    """Trimmed, blanks replaced by underscores."""
    return text.strip().replace(" ", "_")


_RULE = re.compile(
    r"^(?P<column>.+?)(?:-VARCHAR\((?P<size>\d+)\)"
    r"|-DECIMAL\((?P<precision>\d+)\s*,\s*(?P<scale>\d+)\)"
    r"|#DATE\((?P<fmt>[^,)]+)\s*,\s*(?P<nullable>\w+)\)"
    r"|-(?P<integer>INT\w*))$",
    re.IGNORECASE,
)


def parse_rules(text: str) -> RuleSet:
    """``a-VARCHAR(10)|b-DECIMAL(4,2)|c#DATE(yyyyMMdd,true)|d-INT`` as rule objects."""
    found: dict[str, list] = {"length": [], "decimal": [], "date": [], "integer": []}
    for item in filter(None, (piece.strip() for piece in text.split("|"))):
        match = _RULE.match(item)
        if match is None:
            raise ValueError(f"cannot read rule: {item}")
        name = column_name(match["column"])
        if match["size"]:
            found["length"].append(LengthRule(name, int(match["size"]), item))
        elif match["precision"]:
            found["decimal"].append(DecimalRule(name, int(match["precision"]), int(match["scale"]), item))
        elif match["fmt"]:
            found["date"].append(DateRule(name, match["fmt"].strip(), match["nullable"].lower() == "true", item))
        else:
            found["integer"].append(IntegerRule(name, item))
    return RuleSet(**{kind: tuple(rules) for kind, rules in found.items()})


# --- pass conditions --------------------------------------------------------------


def length_ok(value: Column | str, size: int) -> Column:
    c = as_col(value)
    return c.isNull() | (F.length(c) <= size)


def decimal_ok(value: Column | str, precision: int, scale: int) -> Column:
    """A number whose integer part has at most ``precision - scale`` characters (sign aside)."""
    c = as_col(value)
    number = lead_minus(F.trim(c))
    whole = F.substring_index(number, ".", 1)
    room = F.lit(precision - scale) + F.when(number.startswith("-"), 1).otherwise(0)
    return is_blank(c) | F.coalesce(guarded_cast(number, "double").isNotNull() & (F.length(whole) <= room), F.lit(False))


def date_ok(value: Column | str, fmt: str, nullable: bool) -> Column:
    c = as_col(value)
    parsed = parse_date_exact(c, fmt).isNotNull()
    return c.isNull() | c.isin(*ABSENT_DATES) | parsed if nullable else parsed


def integer_ok(value: Column | str) -> Column:
    """A 32-bit integer without blanks; one trailing minus is allowed."""
    c = as_col(value)
    number = lead_minus(c)
    return is_blank(c) | (number.rlike(r"^[+-]?[0-9]+$") & number.try_cast("int").isNotNull())


# --- checks -----------------------------------------------------------------------


def _all(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _reason(template: str, texts: Iterable[str]) -> str:
    return template.format(rules=",".join(texts))


def length_check(rules: Sequence[LengthRule], reject: bool = False, offset: int = 0) -> Check:
    return Check(
        _reason(LENGTH_REASON, (r.text for r in rules)),
        _all(length_ok(r.column, r.size + offset) for r in rules),
        reject,
    )


def decimal_check(rules: Sequence[DecimalRule], reject: bool = False) -> Check:
    """Also rounds: every row that stays carries the rounded text."""
    return Check(
        _reason(DECIMAL_REASON, (r.text for r in rules)),
        _all(decimal_ok(r.column, r.precision, r.scale) for r in rules),
        reject,
        {r.column: round_half_up_text(r.column, r.scale) for r in rules},
    )


def date_check(rules: Sequence[DateRule], reject: bool = False) -> Check:
    return Check(
        _reason(DATE_REASON, (r.text for r in rules)),
        _all(date_ok(r.column, r.fmt, r.nullable) for r in rules),
        reject,
    )


def integer_check(rules: Sequence[IntegerRule], reject: bool = False) -> Check:
    """Also moves trailing minus signs to the front, in rows that stay."""
    return Check(
        _reason(INTEGER_REASON, (r.text for r in rules)),
        _all(integer_ok(r.column) for r in rules),
        reject,
        {r.column: lead_minus(r.column) for r in rules},
    )


def harmonise_check(specs: Sequence[str], out_fmt: str = TEXT_FORMAT, reject: bool = False) -> Check:
    """``col#fmt`` dates rewritten to ``out_fmt``.

    Reported: rows not in the input format. Kept when rejecting: rows that are in
    the output format afterwards, so already-harmonised values are both.
    """
    pairs = [(column_name(c), f.strip()) for c, f in (s.split("#") for s in specs)]
    return Check(
        _reason(HARMONISE_REASON, specs),
        _all(parse_date_exact(c, f).isNotNull() for c, f in pairs),
        reject,
        {c: reformat_date(c, f, out_fmt) for c, f in pairs},
        _all(parse_date_exact(c, out_fmt).isNotNull() for c, _ in pairs),
    )


def not_null_check(columns: Sequence[str], reject: bool = False) -> Check:
    return Check(_reason(NOT_NULL_REASON, columns), _all(as_col(c).isNotNull() for c in columns), reject)


def width_check() -> Check:
    """Records with too few or too many fields fail, whatever their other columns say."""
    return Check(WIDTH_REASON, ~F.col(RAGGED), True, helpers=(RAGGED,))


def rule_checks(
    rules: RuleSet, columns: Sequence[str], reject: Mapping[str, bool] | None = None, length_offset: int = 0
) -> list[Check]:
    """The checks of a rule set in fixed order: length, decimal, date, integer.

    Rules for columns the frame does not have are skipped.
    """
    reject = reject or {}
    present = {
        kind: [r for r in getattr(rules, kind) if r.column in columns]
        for kind in ("length", "decimal", "date", "integer")
    }
    checks = []
    if present["length"]:
        checks.append(length_check(present["length"], reject.get("length", False), length_offset))
    if present["decimal"]:
        checks.append(decimal_check(present["decimal"], reject.get("decimal", False)))
    if present["date"]:
        checks.append(date_check(present["date"], reject.get("date", False)))
    if present["integer"]:
        checks.append(integer_check(present["integer"], reject.get("integer", False)))
    return checks


# --- evaluation -------------------------------------------------------------------


@dataclass(frozen=True)
class Outcomes:
    """What the checks say: ``rows`` has one row per input row.

    ``seen`` names, per check, the column that holds each value as the check saw it.
    """

    rows: DataFrame
    columns: tuple[str, ...]
    reasons: tuple[str, ...]
    seen: tuple[Mapping[str, str], ...]
    written: bool = False

    def staged(self, label: str) -> Outcomes:
        """The same outcomes, evaluated once and read back."""
        return replace(self, rows=stage(self.rows, label), written=True)


def outcomes(df: DataFrame, checks: Sequence[Check]) -> Outcomes:
    """Evaluate the checks in order; a row that an earlier check rejected is not tested further."""
    if len(checks) > MAX_CHECKS:
        raise ValueError(f"at most {MAX_CHECKS} checks")
    columns = [c for c in df.columns if c != RAGGED]
    out = df.withColumns({ALIVE: F.lit(True), FAILED: F.lit(0).cast("bigint")})
    older: dict[str, list[tuple[int, str]]] = {}  # column -> (check that rewrote it, column with the value before)
    for i, check in enumerate(checks):
        if check.attach is not None:
            out = check.attach(out)
        passed = f"_ok{i}"
        out = out.withColumn(passed, F.coalesce(check.ok, F.lit(False)))
        failed = F.when(F.col(ALIVE) & ~F.col(passed), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        added = {FAILED: F.col(FAILED).bitwiseOR(failed)}
        for k, name in enumerate(check.rewrite):
            older.setdefault(name, []).append((i, f"_was{i}_{k}"))
            added[f"_was{i}_{k}"] = as_col(name)
        out = out.withColumns(added)
        if check.rewrite:
            out = out.withColumns(dict(check.rewrite))
        if check.reject:
            stays = F.col(passed) if check.keep is None else F.coalesce(check.keep, F.lit(False))
            out = out.withColumn(ALIVE, F.col(ALIVE) & stays)
        out = out.drop(passed, *check.helpers)
    seen = tuple(
        {c: next((was for at, was in older.get(c, ()) if at >= i), c) for c in columns} for i in range(len(checks))
    )
    return Outcomes(out, tuple(columns), tuple(c.reason for c in checks), seen)


def survivors(found: Outcomes) -> DataFrame:
    if found.written:
        return found.rows.where(ALIVE).select(*[as_col(c) for c in found.columns])
    # a filter on the chain would be moved below it and evaluate it a second time
    row = F.struct(*[as_col(c) for c in found.columns])
    return found.rows.select(F.explode(F.array(F.when(F.col(ALIVE), row))).alias("_r")).where("_r IS NOT NULL").select("_r.*")


def _unfold(found: Outcomes, kept: bool) -> DataFrame:
    def row(seen: Mapping[str, str], reason: Column) -> Column:
        return F.struct(*[as_col(seen.get(c, c)).alias(c) for c in found.columns], reason.alias(REASON))

    failed = F.col(FAILED)
    slots = [
        F.when(failed.bitwiseAND(F.lit(1 << i).cast("bigint")) != 0, row(seen, F.lit(reason)))
        for i, (reason, seen) in enumerate(zip(found.reasons, found.seen, strict=True))
    ]
    if kept:
        slots.append(F.when(F.col(ALIVE), row({}, F.lit(None).cast("string"))))
    if not slots:
        return found.rows.select(*[as_col(c) for c in found.columns], F.lit(None).cast("string").alias(REASON)).where("false")
    # exploding a plain array keeps later filters above the chain, so no rule is evaluated twice
    return found.rows.select(F.explode(F.array(*slots)).alias("_r")).where("_r IS NOT NULL").select("_r.*")


def rejects(found: Outcomes) -> DataFrame:
    """One row per failed check, as that check saw it, with the reason."""
    return _unfold(found, kept=False)


def all_outcomes(found: Outcomes) -> DataFrame:
    """Rejects and survivors in one frame; survivors have no reason."""
    return _unfold(found, kept=True)


def count_outcomes(found: Outcomes, by: str) -> DataFrame:
    """Rows in, rejects and rows out per value of ``by``, in one aggregate."""
    return found.rows.groupBy(as_col(by)).agg(
        F.count("*").alias("rows_in"), F.sum(F.bit_count(FAILED)).cast("bigint").alias("rows_rejected"),
        F.count_if(F.col(ALIVE)).alias("rows_out"),
    )


def apply_checks(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, DataFrame]:
    """(survivors, rejects) as two lazy readings of the outcomes."""
    found = outcomes(df, checks)
    return survivors(found), rejects(found)


# --- rewriting operators outside the reject flow --------------------------------------


def remove_characters(df: DataFrame, specs: Sequence[tuple[str, str]]) -> DataFrame:
    """Strip each ``(column, characters)``; names and column order stay."""
    present = {c: strip_chars(c, chars) for c, chars in specs if c in df.columns}
    return df.withColumns(present) if present else df


def derive_columns(df: DataFrame, specs: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Append derived (partition) columns; returns the frame and their names.

    ``new#col#inFmt#outFmt`` reformats a date, ``new#col`` copies a column and
    ``new#col#expression`` evaluates a SQL expression.
    """
    added: dict[str, Column] = {}
    for spec in specs:
        parts = spec.split("#")
        new, source = parts[0].strip(), column_name(parts[1]) if len(parts) > 1 else ""
        if len(parts) == 4:
            added[new] = date_part_text(source, parts[2].strip(), parts[3].strip())
        elif len(parts) == 3:
            added[new] = F.expr(parts[2].strip())
        elif len(parts) == 2:
            added[new] = as_col(source)
        else:
            raise ValueError(f"cannot read derived column: {spec}")
    return df.select("*", *[c.alias(n) for n, c in added.items()]), list(added)
