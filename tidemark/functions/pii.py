"""Detection of personal data in text with native regular expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import refdata

LEVELS = ["NONE", "LOW", "MEDIUM", "HIGH"]
# A word boundary for ASCII word characters, whatever letters stand around it; before and after a word it takes one look.
_BOUNDARY = "(?:(?<![A-Za-z0-9_])(?=[A-Za-z0-9_])|(?<=[A-Za-z0-9_])(?![A-Za-z0-9_]))"
_BEFORE, _AFTER = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"
# Patterns that may begin with another sign than a word character.
_OTHER_START = ("email", "uk_phone")
# What a text must hold for a pattern to match at all; simple enough to be found at the first look.
_NEEDS = {
    "ni_number": "[0-9]{6}", "nhs_number": "[0-9]{3}", "driving_license": "[0-9]{6}", "uk_phone": "[0-9]{10}",
    "bank_account": "-[0-9]{8}", "credit_card": "[0-9]{4}[\\s-]?[0-9]{4}", "postcode": "[0-9][A-Za-z]{2}",
}


def _texts(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _expressions(kind: str, pattern: str, flags: str) -> tuple[str, str]:
    """The pattern for texts of ASCII characters only, where plain boundaries do, and for others."""
    if kind == "person_name":  # words never give letters back: what follows one is no letter
        pattern = pattern.replace("]+", "]++").replace(r"\s+", r"\s++")
    start = _BOUNDARY if kind in _OTHER_START else _BEFORE
    inner = pattern.removeprefix(r"\b").removesuffix(r"\b")
    return flags + pattern, flags + start + inner + _AFTER


def _facts(text: Column) -> Column:
    """What decides which patterns run: ASCII characters only, three digits in a row, an at sign."""
    return F.struct((F.octet_length(text) == F.length(text)).alias("plain"), text.rlike("[0-9]{3}").alias("digits"),
                    F.contains(text, F.lit("@")).alias("at"))


def match_counts(text: Column, case_sensitive_names: bool = False, facts: Column | None = None) -> Column:
    """Array with the number of matches of each pattern in the whole text, ignoring case.

    ``case_sensitive_names`` restricts person names to capitalised words; ignoring case they match
    nearly any two words. A pattern runs only where the text holds what it needs.
    """
    facts = _facts(text) if facts is None else facts

    def count(kind: str, pattern: str) -> Column:
        flags = "" if kind == "person_name" and case_sensitive_names else "(?i)"
        ascii_only, other = (F.regexp_count(text, F.lit(p)) for p in _expressions(kind, pattern, flags))
        found = F.when(facts["plain"], ascii_only).otherwise(other)
        if kind == "email":
            found = F.when(facts["at"], found)
        elif kind in _NEEDS:
            needed = text.rlike(_NEEDS[kind])
            found = F.when(needed if kind == "postcode" else facts["digits"] & needed, found)
        return F.coalesce(found, F.lit(0))

    return F.array(*[count(kind, pattern) for kind, pattern, _, _ in refdata.PII_PATTERNS])


def highest_level(counts: Column) -> Column:
    """Ordinal of the highest sensitivity among the patterns that matched."""
    return F.greatest(*[F.when(counts[i] > 0, LEVELS.index(s)).otherwise(0) for i, (_, _, s, _) in enumerate(refdata.PII_PATTERNS)])


def finding_struct(counts: Column) -> Column:
    """Struct of findings, sensitivity, categories and pii_count, all over every match.

    ``findings`` has one entry for each pattern that matched, with the number of its matches.
    """
    def where_found(make):
        return F.array_compact(F.array(*[F.when(counts[i] > 0, make(counts[i], *names)) for i, names in enumerate(refdata.PII_PATTERNS)]))

    found = where_found(lambda n, kind, _, sensitivity, category: F.struct(
        F.lit(kind).alias("type"), F.lit(category).alias("category"), F.lit(sensitivity).alias("sensitivity"), n.alias("n")))
    categories = where_found(lambda n, kind, _, sensitivity, category: F.lit(category))
    return F.struct(
        found.alias("findings"),
        name_of(highest_level(counts)).alias("sensitivity"),
        F.sort_array(F.array_distinct(categories)).alias("categories"),
        sum((counts[i] for i in range(1, len(refdata.PII_PATTERNS))), counts[0]).alias("pii_count"))


def detect_pii(text: Column, case_sensitive_names: bool = False) -> Column:
    """Findings of a text as one column. The counts are bound to a lambda variable, so each pattern runs once."""
    return F.get(F.transform(F.array(match_counts(text, case_sensitive_names)), finding_struct), F.lit(0))


def with_findings(df: DataFrame, texts: dict[str, str], case_sensitive_names: bool = False) -> DataFrame:
    """Add a struct of findings under each name of ``texts`` for its text column.

    Facts, counts and findings are made one after the other, so that each pattern runs once and in generated code.
    """
    kept = df.columns
    df = df.withColumns({f"_facts_{out}": _facts(F.col(c)) for out, c in texts.items()})
    df = df.withColumns({f"_counts_{out}": match_counts(F.col(c), case_sensitive_names, F.col(f"_facts_{out}")) for out, c in texts.items()})
    return df.select(*[F.col(f"`{c}`") for c in kept if c not in texts], *[finding_struct(F.col(f"_counts_{out}")).alias(out) for out in texts])


def level_of(sensitivity: Column) -> Column:
    """Ordinal of a sensitivity name (0 for NONE and unknown ones)."""
    return F.greatest(F.coalesce(F.array_position(_texts(LEVELS), sensitivity), F.lit(0)) - 1, F.lit(0)).cast("int")


def name_of(level: Column) -> Column:
    return F.get(_texts(LEVELS), level)


def risk_of(sensitivity: Column) -> Column:
    table = F.create_map(*[F.lit(part) for pair in refdata.SENSITIVITY_RISK.items() for part in pair])
    return F.coalesce(F.try_element_at(table, sensitivity), F.lit(0.0))
