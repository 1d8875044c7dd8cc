"""Row validation with reject reasons (V1) and required-key checks (V2).

A rule is ``(reason, bad)`` where ``bad`` is a boolean ``Column``.  Every rule
is evaluated on every row; all failing reasons are kept, so one row can be
rejected for several reasons and no row is ever dropped: accepted
plus rejected always equals the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The form constraints of the reference's admin and login pages.
# ---------------------------------------------------------------------------
YEAR_MIN = 1000
YEAR_MAX = 2099
QUANTITY_MIN = 0
# The e-mail shape browsers check for <input type="email"> (HTML standard).
EMAIL_PATTERN = (
    r"^[a-zA-Z0-9.!#$%&'*+/=?^_`{|}~-]+@[a-zA-Z0-9](?:[a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?"
    r"(?:\.[a-zA-Z0-9](?:[a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?)*$"
)

Rule = tuple[str, Column]


def required_text(name: str) -> Rule:
    """A required text input: missing when null or empty."""
    c = F.col(name)
    return (f"{name} required", c.isNull() | (c == ""))


def required_value(name: str) -> Rule:
    """A required select / number: missing when null."""
    return (f"{name} required", F.col(name).isNull())


def in_range(name: str, lo: int | None = None, hi: int | None = None) -> Rule:
    """``min`` / ``max`` of a number input; blanks (null) pass."""
    c = F.col(name)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (c < lo)
    if hi is not None:
        bad = bad | (c > hi)
    label = f"{name} out of range" if lo is not None and hi is not None else (
        f"{name} below {lo}" if lo is not None else f"{name} above {hi}")
    return (label, c.isNotNull() & bad)


def email_shape(name: str) -> Rule:
    c = F.col(name)
    return (f"{name} not an e-mail", c.isNotNull() & (c != "") & ~c.rlike(EMAIL_PATTERN))


def iso_date(name: str) -> Rule:
    """A date input's text must be ``yyyy-MM-dd`` when not blank."""
    c = F.col(name)
    return (f"{name} not a date", c.isNotNull() & (c != "") & F.try_to_date(c, "yyyy-MM-dd").isNull())


def book_rules() -> list[Rule]:
    """The book form: title, author, category required; year and quantity ranges."""
    return [
        required_text("title"),
        required_value("author_id"),
        required_value("category_id"),
        in_range("published_year", YEAR_MIN, YEAR_MAX),
        in_range("quantity", lo=QUANTITY_MIN),
    ]


def author_rules() -> list[Rule]:
    return [required_text("full_name"), iso_date("birthdate")]


def category_rules() -> list[Rule]:
    return [required_text("name")]


def user_rules() -> list[Rule]:
    return [required_text("username"), required_text("email"), email_shape("email"), required_text("password")]


def with_reasons(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``reasons`` (the failing rules joined by "; ", null when none) and
    ``n_reasons``.  Plain expressions only, so the check stays in generated
    code."""
    failing = [F.coalesce(bad, F.lit(False)) for _, bad in rules]
    reasons = F.concat_ws("; ", *[F.when(f, F.lit(reason)) for f, (reason, _) in zip(failing, rules)])
    count = sum((f.cast("int") for f in failing), F.lit(0))
    return df.withColumn("reasons", F.nullif(reasons, F.lit(""))).withColumn("n_reasons", count.cast("int"))


def split_valid(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with ``reasons`` and ``n_reasons``)."""
    checked = with_reasons(df, rules)
    accepted = checked.filter(F.col("n_reasons") == 0).drop("reasons", "n_reasons")
    rejected = checked.filter(F.col("n_reasons") > 0)
    return accepted, rejected


def validation_report(df: DataFrame, rules: list[Rule], key: str = "id") -> DataFrame:
    """One row per input row: key, ``is_valid``, ``reasons`` joined by "; "
    (null when valid) and their number."""
    checked = with_reasons(df, rules)
    return checked.select(key, (F.col("n_reasons") == 0).alias("is_valid"), "reasons", "n_reasons")


def has_keys(json_text: Column | str, keys: list[str]) -> dict[str, Column]:
    """For each key, whether the JSON object text contains it (a key
    present with a null value counts as present).  Malformed text -> False."""
    text = F.col(json_text) if isinstance(json_text, str) else json_text
    names = F.json_object_keys(text)
    return {k: F.coalesce(F.array_contains(names, F.lit(k)), F.lit(False)) for k in keys}
