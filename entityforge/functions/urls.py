"""URL columns: canonical form, domains and checks, by regular expressions alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityforge.functions.text import let, strip

#: Query parameters that only track, in lower case.
TRACKING = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "ref", "fbclid", "gclid",
    "mc_cid", "mc_eid", "igshid", "mkt_tok", "hsa_cam", "hsa_grp", "hsa_ad", "hsa_src",
)

#: What is canonical as it stands: a plain host and a path of plain names.
CANONICAL = r"^https://(?!www\.)[a-z0-9.-]+(?:/[A-Za-z0-9._~-]+)*\z"


def _decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def _encode(c: Column) -> Column:
    # Java leaves * as it is and encodes ~; the form that URLs are compared in does the opposite
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def clean_query(query: Column) -> Column:
    """Drops tracking parameters and encodes the others anew; order, repeats and blank values stay."""
    pieces = F.filter(F.split(query, "&"), lambda p: p != "")
    pairs = F.transform(
        pieces, lambda p: F.struct(_decode(F.substring_index(p, "=", 1)).alias("k"), _decode(F.regexp_extract(p, "(?s)^[^=]*=(.*)$", 1)).alias("v"))
    )
    kept = F.filter(pairs, lambda kv: ~F.lower(kv["k"]).isin(*TRACKING))
    return F.array_join(F.transform(kept, lambda kv: F.concat(_encode(kv["k"]), F.lit("="), _encode(kv["v"]))), "&")


def canonical_netloc(netloc: Column) -> Column:
    """Lower case, no leading www., and every `:443`, then every `:80`, cut out, wherever it stands."""
    bare = F.regexp_replace(strip(F.lower(netloc)), r"^www\.", "")
    return F.replace(F.replace(bare, F.lit(":443"), F.lit("")), F.lit(":80"), F.lit(""))


def has_odd_bracket(netloc: Column) -> Column:
    """Whether exactly one of [ and ] occurs, which no address can have."""
    return F.contains(netloc, F.lit("[")) != F.contains(netloc, F.lit("]"))


def normalize_url(c: Column) -> Column:
    """Canonical https URL: no fragment, tracking parameters, default port, www. or trailing slashes.

    Null and '' give ''. Text without a lower-case http(s) scheme is taken for a host. A URL with a
    broken bracket address is left as it is, for validation to find.
    """
    bare = F.regexp_replace(strip(c), "[\t\r\n]", "")

    def split(url: Column) -> Column:
        path = F.regexp_extract(url, "^https?://[^/?#]*([^?#]*)", 1)
        query = clean_query(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1))
        return F.struct(F.regexp_extract(url, "^https?://([^/?#]*)", 1).alias("netloc"), path.alias("path"), query.alias("query"))

    def join(u: Column) -> Column:
        params = F.regexp_extract(u["path"], "(?s)^(?:.*/)?[^/;]*;([^/]*)$", 1)
        path = F.regexp_replace(F.regexp_extract(u["path"], "(?s)^((?:.*/)?[^/;]*)", 1), "/+$", "")
        out = F.concat(
            F.lit("https://"), canonical_netloc(u["netloc"]), path,
            F.when(params != "", F.concat(F.lit(";"), params)).otherwise(""), F.when(u["query"] != "", F.concat(F.lit("?"), u["query"])).otherwise(""),
        )
        return F.when(has_odd_bracket(u["netloc"]), c).otherwise(out)

    made = let(bare, lambda b: let(F.when(b.rlike("^https?://"), b).otherwise(F.concat(F.lit("https://"), b)), lambda url: let(split(url), join)))
    return F.when(c.rlike(CANONICAL), c).when(F.coalesce(c, F.lit("")) == "", "").otherwise(made)


def canonical_domain(c: Column) -> Column:
    """Host in lower case without www. and port; '' where there is none."""
    url = F.when(F.contains(c, F.lit("://")), c).otherwise(F.concat(F.lit("https://"), c))
    host = strip(F.lower(F.regexp_extract(url, "^[^:/?#]*://([^/?#]*)", 1)))
    return F.coalesce(strip(F.substring_index(F.regexp_replace(host, r"^www\.", ""), ":", 1)), F.lit(""))


def valid_url(c: Column) -> Column:
    """Whether it has an http or https scheme and a host."""
    netloc = F.regexp_extract(c, "(?i)^[\\x00-\\x20]*https?://([^/?#]*)", 1)
    return F.coalesce((netloc != "") & ~has_odd_bracket(netloc), F.lit(False))


def same_site(host: Column, official: Column) -> Column:
    """Equal hosts, or one a subdomain of the other; a missing host counts as the same."""
    a, b = F.lower(host), F.lower(official)
    dot = F.lit(".")
    return (a == "") | (a == b) | a.endswith(F.concat(dot, b)) | b.endswith(F.concat(dot, a))


def join_url(base: Column, ref: Column) -> Column:
    """`ref` as seen from the page `base`, for the forms that pages use: absolute, //host, /path, ?query and relative."""
    root = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    page = F.regexp_extract(base, "^([^?#]*)", 1)
    folder = F.when(page == root, F.concat(root, F.lit("/"))).otherwise(F.regexp_extract(page, "^(.*/)", 1))
    flat = F.regexp_replace(F.concat(folder, ref), r"(?<=/)\./", "")
    for _ in range(4):
        flat = F.regexp_replace(flat, r"^([^:]+://[^/]+(?:/.*)?)/(?!\.\./)[^/:]+/\.\./", "$1/")
    flat = F.regexp_replace(flat, r"^([^:]+://[^/]+)/(?:\.\./)+", "$1/")
    return (
        F.when(ref.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), ref)
        .when(ref.startswith("//"), F.concat(scheme, F.lit(":"), ref))
        .when(ref.startswith("/"), F.concat(root, ref))
        .when(ref == "", base)
        .when(ref.startswith("?"), F.concat(page, ref))
        .when(ref.startswith("#"), F.concat(F.regexp_extract(base, "^([^#]*)", 1), ref))
        .otherwise(flat)
    )
