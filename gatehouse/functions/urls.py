"""Service-address rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gatehouse.functions.text import _col, rstrip_slash, strip

# The IPv6 address grammar of RFC 3986 (section 3.2.2), which is
# also what Python's ipaddress accepts: 16-bit groups of 1-4 hex digits, "::"
# standing for at least one zero group, and an optional dotted IPv4 tail whose
# octets have no leading zeros. Non-capturing groups only.
_H16 = r"[0-9a-fA-F]{1,4}"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IPV4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_LS32 = rf"(?:{_H16}:{_H16}|{_IPV4})"
IPV6_PATTERN = "(?:" + "|".join([
    rf"(?:{_H16}:){{6}}{_LS32}",
    rf"::(?:{_H16}:){{5}}{_LS32}",
    rf"(?:{_H16})?::(?:{_H16}:){{4}}{_LS32}",
    rf"(?:(?:{_H16}:){{0,1}}{_H16})?::(?:{_H16}:){{3}}{_LS32}",
    rf"(?:(?:{_H16}:){{0,2}}{_H16})?::(?:{_H16}:){{2}}{_LS32}",
    rf"(?:(?:{_H16}:){{0,3}}{_H16})?::{_H16}:{_LS32}",
    rf"(?:(?:{_H16}:){{0,4}}{_H16})?::{_LS32}",
    rf"(?:(?:{_H16}:){{0,5}}{_H16})?::{_H16}",
    rf"(?:(?:{_H16}:){{0,6}}{_H16})?::",
]) + ")"
# A bracketed host: an IPv6 address with an optional zone ("%eth0"), or the
# "future" form v<hex>.<text> (lower-case v, checked before any case folding).
BRACKETED_HOST = rf"\[(?:{IPV6_PATTERN}(?:%[^%/\]]+)?|v[0-9a-fA-F]+\.[^\]]+)\]"

# Fixed value: the accepted shape of a base address. Scheme http or https in
# any case; optional *empty* user info ("@" or ":@" -- an empty user name or
# password is allowed, a non-empty one is not); a bracketed IP literal (above)
# or a host without blanks or delimiters; an optional port of ASCII digits
# (may be empty, leading zeros allowed); an optional path; no query and no
# fragment, though a bare trailing "?" or "#" (empty query / fragment) is
# allowed. Anchored at the very ends of the text: a line end is no end. Group 3
# is the port.
HOST_SPACE = (r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
              r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
BASE_URL_PATTERN = (
    rf"\A(?i:https?)://(:?@)?({BRACKETED_HOST}|[^{HOST_SPACE}/?#@:\[\]]+)"
    r"(:[0-9]*)?(/[^?#]*)?[?]?#?\z"
)
MAX_PORT = 65535


def valid_base_url(c: Column | str, normalised: bool = False) -> Column:
    """true when the address is usable as a service base.

    Unless ``normalised``, the value is first stripped (P1) and its trailing
    slashes dropped (P2), as the client does before checking it.
    """
    url = _col(c) if normalised else rstrip_slash(strip(c))
    port = F.regexp_replace(F.regexp_extract(url, BASE_URL_PATTERN, 3), "^:0*", "")
    port_ok = (F.length(port) == 0) | ((F.length(port) <= 5) & (port.try_cast("int") <= MAX_PORT))
    return F.coalesce(url.rlike(BASE_URL_PATTERN) & port_ok, F.lit(False))


def target_url(base: Column | str, endpoint: Column | str) -> Column:
    """Plain concatenation; a missing endpoint gives null (see F4)."""
    return F.concat(_col(base), _col(endpoint))
