"""E-mail, web address and person-name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowproof.functions.text import col, only_letters, strip

# --- fixed values: e-mail and web patterns ----------------------------------------------------
EMAIL_CHECK = r"\A\b[A-Za-z0-9.'_%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,20}\b\z"
EMAIL_LOCAL = r"[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+(?:\.[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+)*"
EMAIL_DOMAIN = (
    r"(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+"
    r"(?:[A-Za-z0-9][A-Za-z0-9-]{0,61})?[A-Za-z]"
)
EMAIL_SYNTAX = rf"\A{EMAIL_LOCAL}@{EMAIL_DOMAIN}\z"
URL_START = r"\A[\x00-\x20]*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]"
URL_HOST = r"://([^/?#]*)"


def email_check(email: Column | str) -> Column:
    return F.coalesce(col(email).rlike(EMAIL_CHECK), F.lit(False))


def email_valid(email: Column | str) -> Column:
    """Address with a lower-case domain when its syntax and lengths are right, else null."""
    e = col(email)
    at = F.locate("@", e)
    local, domain = F.substr(e, F.lit(1), at - 1), F.substr(e, at + 1)
    right = e.rlike(EMAIL_SYNTAX) & (at <= 65) & (F.length(e) <= 254)
    return F.when(right, F.concat(local, F.lit("@"), F.lower(domain)))


def website_check(url: Column | str) -> Column:
    """Scheme and host are present, and square brackets in the host come in pairs."""
    u = col(url)
    host = F.regexp_extract(u, URL_HOST, 1)
    paired = host.contains("[") == host.contains("]")
    return F.coalesce(u.rlike(URL_START) & paired, F.lit(False))


def name_check(name: Column | str) -> Column:
    return only_letters(name)


def name_format(name: Column | str) -> Column:
    """Valid names unchanged; else only ASCII letters, spaces, quotes and hyphens are kept."""
    n = col(name)
    return F.when(name_check(n), n).otherwise(strip(F.regexp_replace(n, r"[^A-Za-z '\-]+", "")))
