"""URL and host scalars, by one shared pattern: the JVM's own URL parser refuses many URLs that browsers accept.

Null and unreadable URLs give ''.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelode.functions.text import any_word, as_col, let
from pagelode.profile import BRAND_STOP_WORDS, LISTING_HOSTS, NY, TWO_LABEL_SUFFIXES, VANITY_LABELS, Profile

HOST = "^(?i)https?:[/\\\\]*(?:[^/?#@\\\\]*@)?([^/?#\\\\]*)"


def prefer_https(c: Column | str) -> Column:
    return F.regexp_replace(as_col(c), "^(?i)http://", "https://")


def registrable_domain(c: Column | str) -> Column:
    """Host of a URL with its port unless it is the scheme's own, or the text itself if it is no URL; without www., lower case."""

    def body(t: Column) -> Column:
        host = F.regexp_replace(F.regexp_extract(t, HOST, 1), "^(.*):$", "$1")
        host = F.when(t.rlike("^(?i)http:"), F.regexp_replace(host, ":80$", "")).otherwise(F.regexp_replace(host, ":443$", ""))
        return F.lower(F.regexp_replace(F.when(t.rlike("^(?i)https?:"), host).otherwise(t), "^(?i)www\\.", ""))

    return let(F.trim(F.coalesce(as_col(c), F.lit(""))), body)


def apex_domain(c: Column | str) -> Column:
    """registrable_domain without leading labels that are plumbing; two labels stay, three where the last two are a public suffix."""
    vanity = F.array(*[F.lit(v) for v in VANITY_LABELS])

    def body(parts: Column) -> Column:
        least = F.when(F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), F.lit(2)), ".").isin(*TWO_LABEL_SUFFIXES), 3).otherwise(2)
        lead = F.aggregate(parts, F.struct(F.lit(0).alias("n"), F.lit(True).alias("go")), lambda s, p: F.struct((s["n"] + (s["go"] & F.array_contains(vanity, p)).cast("int")).alias("n"), (s["go"] & F.array_contains(vanity, p)).alias("go")))
        cut = F.greatest(F.least(lead["n"], F.size(parts) - least), F.lit(0))
        return F.array_join(F.slice(parts, cut + 1, F.size(parts)), ".")

    return let(F.split(registrable_domain(c), "\\."), body)


def last_two_labels(c: Column | str) -> Column:
    return let(F.split(F.coalesce(as_col(c), F.lit("")), "\\."), lambda p: F.array_join(F.slice(p, F.greatest(F.size(p) - 1, F.lit(1)), F.lit(2)), "."))


def is_listing_host(c: Column | str) -> Column:
    """Whether a host contains one of the listing sites' names, anywhere in it."""
    return F.lower(F.coalesce(as_col(c), F.lit(""))).rlike(any_word(set(LISTING_HOSTS)))


def is_government_host(c: Column | str, profile: Profile = NY) -> Column:
    return F.coalesce(as_col(c), F.lit("")).rlike(f"(?i){profile.gov_suffix}")


def unwrap_redirect(c: Column | str) -> Column:
    """Target of a search engine's click-tracking link; other URLs as they are; '' where there is no target."""

    def param(t: Column, name: str) -> Column:
        return F.regexp_extract(t, f"[?&]{name}=([^&#]*)", 1)

    def body(t: Column) -> Column:
        host = F.regexp_replace(registrable_domain(t), ":\\d+$", "")
        path = F.regexp_extract(t, "^(?i)https?:[/\\\\]*[^/?#]*([^?#]*)", 1)
        http = lambda x: F.when(x.rlike("^(?i)https?://"), x).otherwise("")
        code = F.translate(F.regexp_replace(F.coalesce(F.try_url_decode(param(t, "u")), F.lit("")), "^a1", ""), "-_", "+/")
        padded = F.rpad(code, (F.length(code) + (4 - F.length(code) % 4) % 4).cast("int"), "=")
        data = F.try_to_binary(padded, F.lit("base64"))
        bing = F.coalesce(F.when(F.is_valid_utf8(data.cast("string")), F.decode(data, "utf-8")), F.lit(""))
        duck = F.coalesce(F.try_url_decode(param(t, "uddg")), F.lit(""))
        yahoo = F.coalesce(F.try_url_decode(F.regexp_replace(F.regexp_extract(path, "/RU=([^/]+)", 1), "\\+", "%2B")), F.lit(""))
        return (
            F.when(~t.rlike("^(?i)[a-z][a-z0-9+.-]*:"), "").when((host == "bing.com") & path.startswith("/ck/"), http(bing)).when((host == "duckduckgo.com") & path.startswith("/l/"), http(duck))
            .when(host.endswith("yahoo.com") & path.contains("/RU="), http(yahoo)).otherwise(t)
        )

    return let(F.coalesce(as_col(c), F.lit("")), body)


def without_dots(path: Column) -> Column:
    """A path whose '.' and '..' segments are worked off; what would climb over the root stays there."""

    def step(done: Column, s: Column) -> Column:
        up = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(s == "..", up).when(s == ".", done).otherwise(F.concat(done, F.array(s)))

    def body(parts: Column) -> Column:
        tail = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
        kept = F.concat(F.aggregate(F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"), step), tail)
        return F.concat(F.lit("/"), F.array_join(kept, "/"))

    return F.when(path.rlike("(?:^|/)\\.{1,2}(?:/|$)"), let(F.split(path, "/"), body)).otherwise(path)


def absolute_url(href: Column | str, base: Column | str) -> Column:
    """A link made absolute against its page: full, scheme-relative, rooted and plain relative forms, dot segments worked off."""
    h, b = as_col(href), as_col(base)
    scheme, root = F.regexp_extract(b, "^(https?:)", 1), F.regexp_extract(b, "^(https?://[^/?#]*)", 1)
    page = F.regexp_replace(b, "[?#].*$", "")
    folder = F.regexp_replace(F.regexp_replace(page, "^(https?://[^/]*)", ""), "[^/]*$", "")
    path, query = F.regexp_replace(h, "[?#].*$", ""), F.regexp_extract(h, "([?#].*)$", 1)
    rooted = F.when(h.startswith("/"), path).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), path))
    return F.when(h.rlike("^(?i)[a-z][a-z0-9+.-]*:"), h).when(h.startswith("//"), F.concat(scheme, h)).when(h.rlike("^[?#]"), F.concat(page, h)).otherwise(F.concat(root, without_dots(rooted), query))


def brand_tokens(domain: Column | str, name: Column | str) -> Column:
    """Telling words of a host and a name: five letters or more, without the trade's own words."""
    d = F.regexp_replace(F.coalesce(as_col(domain), F.lit("")), "\\.[a-z.]+$", "")
    words = F.concat(F.split(F.lower(d), "[^a-z]+"), F.split(F.lower(F.coalesce(as_col(name), F.lit(""))), "[^a-z]+"))
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) >= 5) & ~w.isin(*BRAND_STOP_WORDS)))


def attempts(url: Column | str, domain: Column | str) -> Column:
    """The addresses under which a site is tried, in order, each once."""
    u = F.coalesce(as_col(url), F.lit(""))
    return F.array_distinct(F.filter(F.array(prefer_https(u), F.concat(F.lit("https://www."), F.coalesce(as_col(domain), F.lit(""))), u), lambda x: ~x.isin("", "https://www.")))
