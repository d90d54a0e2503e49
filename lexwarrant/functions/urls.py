"""Addresses: registrable domains, links out of pages and feeds, robots rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Suffixes under which anyone may register, so that the label before them is part of the domain.
SUFFIXES = (
    "co.uk", "org.uk", "me.uk", "gov.uk", "ac.uk", "co.jp", "or.jp", "ne.jp", "ac.jp", "go.jp", "com.au", "net.au",
    "org.au", "edu.au", "gov.au", "com.br", "com.mx", "com.ar", "com.ph", "net.ph", "org.ph", "gov.ph", "edu.ph",
    "com.sg", "com.my", "com.tr", "com.cn", "com.tw", "com.hk", "co.kr", "or.kr", "go.kr", "co.in", "co.za", "org.za",
    "net.nz", "org.nz", "govt.nz", "com.ng", "org.ng", "gov.ng", "com.pe", "com.co", "com.ve", "com.ec", "com.uy",
    "com.py", "com.bo", "net.pe", "gob.mx", "gob.ar", "gob.pe", "gob.cl", "net.br", "org.br", "gov.br", "net.in",
    "org.in", "gov.in", "ac.in", "net.tr", "org.tr", "gov.tr", "co.nz", "com.pl", "com.ua", "com.vn", "co.id",
    "or.id", "go.id",
)

# Fixed values too: what is a link in a page, a sitemap or a feed.
ANCHOR = r"""(?i)<a\b[^>]*\bhref=["']([^"'#]+)["']"""
LOCATION = r"<loc>\s*([^<\s]+)\s*</loc>"
INDEX = r"<sitemapindex[\s>]"
FEED_TEXT, FEED_HREF = r"<link>\s*([^<\s]+)\s*</link>", r'<link\b[^>]*\bhref="([^"]+)"'

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)"


#: What fetchers call themselves, and robots rules address.
AGENT = "word-evidence"


def domain_of(url: Column) -> Column:
    """The registrable domain; what isn't an address is returned whole, in lower case."""
    host = F.regexp_extract(url, _HOST, 1)
    labels = F.split(F.regexp_replace(F.lower(host), r"^www\.", ""), r"\.")
    last = lambda n: F.array_join(F.slice(labels, -n, n), ".")
    listed = F.array_contains(F.array(*map(F.lit, SUFFIXES)), last(2))
    short = F.array_join(labels, ".")
    return F.when(host == "", F.lower(url)).when(F.size(labels) <= 2, short).when(listed, last(3)).otherwise(last(2))


def path_of(url: Column) -> Column:
    """The path of an address, ``/`` where it has none; null for what isn't an address."""
    path = F.regexp_extract(url, _PATH, 1)
    return F.when(F.regexp_extract(url, _HOST, 1) == "", F.lit(None)).when(path == "", F.lit("/")).otherwise(path)


def allowed(url: Column, disallowed: Column) -> Column:
    """Whether no disallowed prefix begins the path; false for what isn't an address."""
    path = path_of(url)
    return F.coalesce(path.isNotNull() & ~F.exists(disallowed, lambda p: F.startswith(path, p)), F.lit(False))


def disallowed_paths(robots: Column, agent: str = AGENT) -> Column:
    """Paths forbidden to everyone or to ``agent``, in order.

    Each User-agent line decides anew whether what follows applies, so in a group of several the last
    one does. Comments go; Allow and wildcards aren't read.
    """
    step_type = "struct<applies:boolean,paths:array<string>>"
    start = F.struct(F.lit(False).alias("applies"), F.array().cast("array<string>").alias("paths")).cast(step_type)

    def step(state: Column, raw: Column) -> Column:
        line = F.trim(F.regexp_replace(raw, "#.*$", ""))
        line = F.regexp_replace(line, r"^[\s]+|[\s]+$", "")
        at = F.instr(line, ":")
        field, value = F.lower(F.trim(F.substring(line, F.lit(1), at - 1))), F.regexp_replace(F.substring(line, at + 1, F.length(line)), r"^\s+|\s+$", "")
        is_agent = (at > 1) & (field == "user-agent")
        is_rule = (at > 1) & (field == "disallow") & state["applies"] & (value != "")
        return F.struct(
            F.when(is_agent, (value == "*") | (F.lower(value) == agent)).otherwise(state["applies"]).alias("applies"),
            F.when(is_rule, F.concat(state["paths"], F.array(value))).otherwise(state["paths"]).alias("paths"),
        ).cast(step_type)

    return F.aggregate(F.split(robots, "\n"), start, step)["paths"]


def sitemap_links(xml: Column) -> Column:
    return F.regexp_extract_all(xml, F.lit(LOCATION), F.lit(1))


def is_sitemap_index(xml: Column) -> Column:
    return xml.rlike(INDEX)


def feed_links(xml: Column) -> Column:
    """Links of a feed: element text first, then href attributes, each once."""
    rss = F.regexp_extract_all(xml, F.lit(FEED_TEXT), F.lit(1))
    atom = F.regexp_extract_all(xml, F.lit(FEED_HREF), F.lit(1))
    return F.array_distinct(F.concat(rss, atom))


_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?:(//)([^/?#]*))?([^?#]*)(\?[^#]*)?"
#: Schemes whose addresses have a host, and the ports that go without saying.
_PORTS = {"http": "80", "https": "443", "ftp": "21", "ws": "80", "wss": "443"}
_HOST_NAME = r"^(?:[^@/]*@)?(?:[^\x00-\x20\[\]<>^|%#@:?/\\]+|\[[0-9a-f:.]+\])(?::[0-9]{1,5})?$"
# What a path and a query keep of what encoding all but letters, digits and ``.*_-`` changes.
_IN_PATH, _IN_QUERY = "!$&'()+,/:;=@[\\]^|~", "!$&()+,/:;=?@[\\]^`{|}~"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def without_dots(path: Column) -> Column:
    """A path that begins with a slash, its ``.`` and ``..`` segments resolved, by a fold over its segments."""

    def plain(x: Column) -> Column:
        return F.when(F.lower(x).isin(".", "%2e"), ".").when(F.lower(x).isin("..", ".%2e", "%2e.", "%2e%2e"), "..").otherwise(x)

    def step(held: Column, x: Column) -> Column:
        up = F.slice(held, F.lit(1), F.greatest(F.size(held) - 1, F.lit(0)))
        return F.when(x == ".", held).when(x == "..", up).otherwise(F.concat(held, F.array(x)))

    def fold(segments: Column) -> Column:
        kept = F.aggregate(segments, F.array().cast("array<string>"), step)
        # one that ends in dots is a folder
        end = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
        return F.concat(F.lit("/"), F.array_join(F.concat(kept, end), "/"))

    resolved = _let(F.transform(F.split(F.substring(path, F.lit(2), F.length(path)), "/"), plain), fold)
    return F.when(path.rlike(r"/(?:\.|%2[eE])"), resolved).otherwise(path)


def _encoded(text: Column, kept: str) -> Column:
    """``text`` percent-encoded but for characters that may stand there; what is encoded already stays."""
    out = F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))
    for c in (*kept, "%"):  # the sign itself last, lest what it begins be read again
        out = F.replace(out, F.lit(f"%{ord(c):02X}"), F.lit(c))
    return F.when(text.rlike(r"[^A-Za-z0-9./?&=_~:%+,;@!$()*-]"), out).otherwise(text)


def _parts(url: Column) -> Column:
    """An address by its scheme, the slashes before its host, host, path and query."""
    return F.struct(*(F.regexp_extract(url, _PARTS, i).alias(n) for i, n in enumerate(("scheme", "slashes", "host", "path", "query"), 1)))


def _against(ref: Column, base: Column) -> Column:
    """An address by its parts, read against a page by its parts, which has a scheme with hosts in the end."""
    # one that names its scheme and no host is read against the page if it names the page's
    near = (ref["slashes"] == "") & ((ref["scheme"] == "") | (F.lower(ref["scheme"]) == F.lower(base["scheme"])))
    folder = F.regexp_extract(base["path"], r"^(?s)(.*/)?", 0)
    path = F.when(~near | F.startswith(ref["path"], F.lit("/")), ref["path"]).when(ref["path"] == "", base["path"]).otherwise(F.concat(folder, ref["path"]))
    query = F.when(near & (ref["path"] == "") & (ref["query"] == ""), base["query"]).otherwise(ref["query"])
    scheme = F.lower(F.when(ref["scheme"] == "", base["scheme"]).otherwise(ref["scheme"]))
    made = F.struct(scheme.alias("scheme"), F.lower(F.when(near, base["host"]).otherwise(ref["host"])).alias("host"), F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit("/"), path)).alias("path"), query.alias("query"))
    return _let(made, _written)


def _written(parts: Column) -> Column:
    """The address of its parts; null if there can't be such a host."""
    port = F.regexp_extract(parts["host"], r":([0-9]*)$", 1)
    usual = port.isin("") | F.coalesce(port == F.get(F.array(*map(F.lit, _PORTS.values())), F.array_position(F.array(*map(F.lit, _PORTS)), parts["scheme"]).cast("int") - 1), F.lit(False))
    host = F.when(usual, F.regexp_replace(parts["host"], r":[0-9]*$", "")).otherwise(parts["host"])
    address = lambda h: F.when(h.rlike(_HOST_NAME), F.concat(parts["scheme"], F.lit("://"), h, _encoded(without_dots(parts["path"]), _IN_PATH), _encoded(parts["query"], _IN_QUERY)))
    return _let(host, address)


def _resolved(href: Column, base: Column) -> Column:
    """``href`` against a page by its parts."""
    trimmed = F.when(href.rlike(r"[\x00-\x20]"), F.regexp_replace(F.regexp_replace(href, r"[\t\n\r]", ""), r"^[\x00-\x20]+|[\x00-\x20]+$", "")).otherwise(href)

    def read(text: Column) -> Column:
        own = F.lower(F.regexp_extract(text, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
        web = F.when(own == "", F.lower(base["scheme"])).otherwise(own).isin(*_PORTS)
        # backslashes before the query are slashes
        slashed = F.when(F.contains(text, F.lit("\\")), F.concat(F.replace(F.regexp_extract(text, r"^[^?#]*", 0), F.lit("\\"), F.lit("/")), F.regexp_extract(text, r"[?#](?s).*$", 0))).otherwise(text)
        return F.when(web, _let(_parts(slashed), lambda ref: _against(ref, base))).when(own != "", text)

    return _let(trimmed, read)


def absolute(href: Column, base: Column) -> Column:
    """``href`` made absolute against the page ``base``; null if it can't be.

    Scheme and host are in lower case, a bare host has its slash, usual ports go, dot segments are resolved,
    and other characters are encoded. Backslashes count as slashes; white space around and line ends within
    don't count. Host names beyond ASCII stay as they are.
    """
    return _let(_parts(F.coalesce(base, F.lit(""))), lambda b: _resolved(href, b))


def page_links(html: Column, base: Column) -> Column:
    """Absolute links of a page, each once, in order. An href with a fragment is no match; a query stays."""
    found = F.filter(F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(1)), lambda h: ~h.rlike("(?i)^(?:mailto|javascript|tel):"))
    links = _let(_parts(F.coalesce(base, F.lit(""))), lambda b: F.transform(found, lambda h: _resolved(h, b)))
    return F.array_distinct(F.filter(links, lambda u: u.isNotNull()))
