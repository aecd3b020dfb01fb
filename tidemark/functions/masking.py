"""Masking of personal data as native column expressions (null and empty values pass through)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import refdata


def _stars(n: Column) -> Column:
    return F.repeat(F.lit("*"), n)


def _blank(value: Column) -> Column:
    return value.isNull() | (value == "")


def _words(value: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(value, r"\s+", " ")), " ")


def mask_email(email: Column) -> Column:
    """First and last letter of the user, the domain kept; text without ``@`` is returned as it is."""
    parts = F.split(email, "@")
    user, domain = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    size = F.length(user)
    hidden = F.when(size > 2, F.concat(F.left(user, F.lit(1)), _stars(size - 2), F.right(user, F.lit(1)))).otherwise("***")
    return F.when(_blank(email) | ~F.contains(email, F.lit("@")), email).otherwise(F.concat(hidden, F.lit("@"), domain))


def mask_phone(phone: Column) -> Column:
    """First four and last two digits of a full number, nothing of a short one."""
    digits = F.regexp_replace(phone, "[ -]", "")
    size = F.length(digits)
    full = F.concat(F.left(digits, F.lit(4)), _stars(size - 6), F.right(digits, F.lit(2)))
    return F.when(_blank(phone), phone).when(size >= 10, full).otherwise(_stars(size))


def mask_name(name: Column) -> Column:
    """Initials of the first and the last word, or of a single one."""
    words = _words(name)
    first, last = F.get(words, F.lit(0)), F.element_at(words, -1)
    initial = lambda c: F.concat(F.left(c, F.lit(1)), F.lit("***"))
    return (F.when(_blank(name), name)
            .when(F.size(words) >= 2, F.concat(initial(first), F.lit(" "), initial(last))).otherwise(initial(name)))


def mask_address(address: Column) -> Column:
    """First word and the first two characters of a postcode, if there is one."""
    words = _words(address)
    first = F.get(words, F.lit(0))
    code = F.regexp_extract(address, refdata.MASK_POSTCODE, 0)
    with_code = F.concat(first, F.lit(" ***, "), F.left(code, F.lit(2)), F.lit("** ***"))
    return (F.when(_blank(address), address).when((F.size(words) > 1) & (code != ""), with_code)
            .when(first != "", F.concat(first, F.lit(" ***"))).otherwise("***"))


def hash_id(value: Column, salt: str = refdata.ID_SALT) -> Column:
    """One-way reference: 16 hex digits of the salted SHA-256."""
    return F.when(_blank(value), value).otherwise(F.left(F.sha2(F.concat(value, F.lit(salt)), 256), F.lit(16)))
