"""Masking of personal data.

The documentation of the data contract promises masked clean data. Here it is: an address loses
its last octet, user ids can be replaced by a salted digest, and e-mail addresses, telephone
numbers and IP addresses inside free text are replaced by a tag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A local part starts where a run of its characters does, or right after the address before, and
# gives nothing back: so a long run that is no address is read once.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IPV4 = r"\b[0-9]{1,3}(\.[0-9]{1,3}){3}\b"
PHONE = r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}"

# Order matters: an address must be gone before the telephone pattern sees its digits.
# The character tells whether a text can have a match at all.
TEXT_MASKS = ((EMAIL, "<email>", "@"), (IPV4, "<ip>", "."), (PHONE, "<phone>", "+"))


def mask_ip(ip: Column) -> Column:
    """Replace the last octet of an IPv4 address by ``x``; other text is left as it is."""
    return F.regexp_replace(ip, r"^([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})\.[0-9]{1,3}$", "$1.x")


def mask_text(text: Column) -> Column:
    """Replace e-mail addresses, IPv4 addresses and telephone numbers over the whole text."""
    for pattern, tag, needed in TEXT_MASKS:
        text = F.when(F.contains(text, F.lit(needed)), F.regexp_replace(text, pattern, tag)
                      ).otherwise(text)
    return text


def pseudonym(user_id: Column, salt: str) -> Column:
    """Salted SHA-256 of an id: equal ids stay joinable, null stays null."""
    return F.sha2(F.concat(F.lit(salt), user_id), 256)


def mask_table(df: DataFrame, salt: str | None = None) -> DataFrame:
    """Mask the address and free-text columns a table has, and with a salt its user ids too."""
    masks = {"ip": mask_ip, "review_text": mask_text, "content": mask_text}
    if salt is not None:
        masks["user_id"] = lambda user: pseudonym(user, salt)
    return df.withColumns({c: mask(F.col(c)) for c, mask in masks.items() if c in df.columns})
