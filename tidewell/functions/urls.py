"""URL identity and parsing, as Column expressions.

Two URLs are one job if their url_key is equal; canonical_url is the spelling that is
stored. Nothing is decoded or encoded again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query names that tell how a visitor came, never which page it is.
TRACKING_NAMES = (
    "refid", "trackingid", "position", "pagenum", "currentjobid", "trk", "trkinfo", "gclid", "fbclid", "msclkid", "dclid", "yclid", "igshid", "gbraid", "wbraid",
    "src", "source", "gh_src", "ref", "referrer", "referral", "referred_by", "ebp", "iis", "iisn", "sid", "campaign", "fromsearch", "mkt_tok",
)
TRACKING_PREFIXES = ("utm_", "lever-", "mc_", "_hs", "pk_", "hsa_")
#: Hosts whose board slug ignores case.
LOWER_PATH_HOST, LOWER_BOARD_SUFFIX = "jobs.ashbyhq.com", ".myworkdayjobs.com"

_URL = r"^\s*([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*?))?\s*$"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _URL, 1))


def host(url: Column) -> Column:
    """Lower-case authority, with its port."""
    return F.lower(F.regexp_extract(url, _URL, 2))


def path(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 3)


def query(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 4)


def fragment(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 5)


def let(value: Column, body) -> Column:
    """body(value), with value computed once for each row."""
    return F.transform(F.array(value), body)[0]


def parts(url: Column) -> Column:
    """All five parts of a URL as one struct (s, h, p, q, f)."""
    return F.struct(scheme(url).alias("s"), host(url).alias("h"), path(url).alias("p"), query(url).alias("q"), fragment(url).alias("f"))


def segments(p: Column) -> Column:
    """Non-empty segments of a path."""
    return F.filter(F.split(p, "/"), lambda s: s != "")


def is_tracking(name: Column) -> Column:
    low = F.lower(name)
    out = low.isin(*TRACKING_NAMES)
    for prefix in TRACKING_PREFIXES:
        out = out | low.startswith(prefix)
    return out


def _name(piece: Column) -> Column:
    return F.substring_index(piece, "=", 1)


def clean_query(q: Column) -> Column:
    """Raw pieces of a query that track nobody, in order."""
    return F.filter(F.split(q, "&"), lambda p: (p != "") & ~is_tracking(_name(p)))


def lower_but_escapes(s: Column) -> Column:
    """Lower case, the digits of percent escapes in upper case."""
    fixed = F.transform(
        F.split(F.lower(s), "%"),
        lambda p, i: F.when((i > 0) & p.rlike("^[0-9a-f]{2}"), F.concat(F.upper(F.substring(p, 1, 2)), F.substring(p, 3, 1 << 30))).otherwise(p),
    )
    return F.array_join(fixed, "%")


def _joined(u: Column, p: Column, pieces: Column) -> Column:
    """A URL of parts u with another path and query."""
    p = let(p, lambda x: F.when((x != "") & ~x.startswith("/"), F.concat(F.lit("/"), x)).otherwise(x))
    q = let(F.array_join(pieces, "&"), lambda x: F.when(x != "", F.concat(F.lit("?"), x)).otherwise(""))
    return F.concat(u["s"], F.lit("://"), u["h"], p, q, F.when(u["f"] != "", F.concat(F.lit("#"), u["f"])).otherwise(""))


def _canonical_path(h: Column, p: Column) -> Column:
    def board(segs):
        at = F.when(F.get(segs, F.lit(0)).rlike("^[a-z]{2}(-[A-Za-z]{2})?$") & (F.size(segs) > 1), 1).otherwise(0)
        fixed = F.transform(segs, lambda s, i: F.when((h == LOWER_PATH_HOST) | (i == at), lower_but_escapes(s)).otherwise(s))
        return F.when((h == LOWER_PATH_HOST) | (F.size(segs) > 0), F.concat(F.lit("/"), F.array_join(fixed, "/"))).otherwise(p)

    return F.when((h == LOWER_PATH_HOST) | h.endswith(LOWER_BOARD_SUFFIX), let(segments(p), board)).otherwise(p)


def canonical_url(url: Column) -> Column:
    """The stored spelling: only changes that cannot break the link."""
    out = let(parts(url), lambda u: _joined(u, _canonical_path(u["h"], u["p"]), clean_query(u["q"])))
    return F.when(url.isNull() | ~url.contains("://"), url).otherwise(out)


def _key_path(p: Column) -> Column:
    folded = let(lower_but_escapes(F.regexp_replace(p, "/{2,}", "/")), lambda x: F.struct(x.alias("x"), F.rtrim(x, F.lit("/")).alias("r")))
    return let(folded, lambda x: F.when(F.length(x["x"]) <= 1, x["x"]).when(x["r"] == "", "/").otherwise(x["r"]))


def url_key(url: Column) -> Column:
    """Identity: path case, doubled and final slashes, query order and tracking do not matter."""

    def piece(x):
        return F.concat(F.lower(_name(x)), F.when(x.contains("="), F.substring(x, F.instr(x, "="), F.lit(1 << 30))).otherwise(""))

    out = let(parts(url), lambda u: _joined(u, _key_path(u["p"]), F.array_sort(F.transform(clean_query(u["q"]), piece))))
    return F.when(url.isNull(), "").when(~url.contains("://"), url).otherwise(out)


def clean_domain(s: Column) -> Column:
    """Lower-case host of a loosely written site."""
    return F.lower(F.substring_index(F.regexp_replace(F.trim(s), r"^(?i)https?://", ""), "/", 1))


def reverse_domain(d: Column) -> Column:
    return F.array_join(F.reverse(F.split(d, r"\.")), ".")


def site_key(h: Column) -> Column:
    """The last two labels of a host without port."""
    labels = F.split(F.regexp_replace(F.lower(h), r":\d+$", ""), r"\.")
    return F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")


def is_sentence_slug(p: Column, words: int = 6) -> Column:
    """The last segment of a path has more hyphenated words than a page's name has."""
    segs = segments(p)
    last = F.element_at(segs, -1)
    return F.when(F.size(segs) > 0, F.size(F.filter(F.split(last, "-"), lambda w: w != "")) > words).otherwise(False)


def title_case(s: Column) -> Column:
    """First letter of every run of letters in upper case, the others in lower case."""
    runs = F.regexp_extract_all(s, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30)))), "")


def slug_title(url: Column) -> Column:
    """A title guessed from the last segment: without extension, ids and leading numbers; '' if fewer than two words are left."""
    last = F.element_at(segments(path(url)), -1)
    words = F.filter(F.split(F.regexp_replace(last, r"\.[A-Za-z]{2,5}$", ""), r"[-_+]+|%20"), lambda w: w != "")
    keep = F.filter(words, lambda w: ~w.rlike(r"^\d+$|^[0-9a-fA-F]{8,}$|^.{21,}$"))
    return F.when(F.size(segments(path(url))) == 0, "").when(F.size(keep) >= 2, title_case(F.array_join(keep, " "))).otherwise("")


#: Names of a page number in a query.
PAGE_NAMES = ("page", "p", "pg", "paged", "pagenum", "page_num", "pagenumber", "pageno", "page_no", "pn", "currentpage")


def page_number(url: Column) -> Column:
    """The page number in a URL's query or path; NULL if there is none."""
    named = F.filter(F.split(query(url), "&"), lambda p: F.lower(_name(p)).isin(*PAGE_NAMES) & F.substring_index(p, "=", -1).rlike(r"^\d{1,6}$"))
    of_query = F.substring_index(F.get(named, F.lit(0)), "=", -1).cast("int")
    of_path = F.nullif(F.regexp_extract(path(url), r"(?i)/page/(\d{1,6})(?:/|$)", 1), F.lit("")).cast("int")
    return F.coalesce(of_query, of_path)


def company_of_host(h: Column) -> Column:
    """A company's name from its host: the label before the suffix, words in title case."""
    return title_case(F.regexp_replace(F.substring_index(F.regexp_replace(F.lower(h), r"^(www|careers|jobs|m|blog)\.", ""), ".", 1), "[-_]+", " "))
