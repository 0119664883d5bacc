"""Facts read out of page text and markup, as JVM expressions.

Null text counts as ''. Patterns use ASCII word boundaries and classes, so accented letters do not change a match.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelode.functions.text import any_word, as_col, ascii_words, decode_entities, let, local_letters, normalize_city, normalize_separators
from pagelode.functions.urls import absolute_url, brand_tokens, last_two_labels
from pagelode.profile import (
    CASE_BOUND, EXCLUDED, FREE_MAIL_SEEN, GENERIC_TITLES, INDOOR, NAME_KINDS, NOT_A_FIRST_NAME, NOT_A_NAME, NUMBER_WORDS, NY, OUTDOOR, PAID, RETAIL_SIGNALS,
    SHARED_LOCALS, STREET_SUFFIXES, STREET_WORDS, SUBPAGE_HINTS, TEXT_KINDS, TITLES, Profile,
)

EMAIL = ascii_words("\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}\\b")
NAME = "[A-Z][a-zA-Z'’.-]+(?:[ ]+[A-Z][a-zA-Z'’.-]+){0,2}"
NONE = lambda: F.array().cast("array<string>")


def text_of(c: Column | str) -> Column:
    return F.coalesce(as_col(c), F.lit(""))


def one_line(c: Column | str) -> Column:
    return F.regexp_replace(text_of(c), "[\\s\\u00a0\\ufeff]+", " ")


def links(html: Column | str, base: Column | str) -> Column:
    """array<struct<href,text>> of a page's links in order, absolute, their text trimmed and cut to 120 characters."""
    value = "(?:\"[^\"]*\"|'[^']*'|[^\\s\"'>]+)"
    found = F.regexp_extract_all(text_of(html), F.lit(f"(?is)<a\\b[^>]*?\\bhref\\s*=\\s*{value}[^>]*>.*?</a\\s*>"), F.lit(0))
    href = lambda a: F.regexp_replace(F.regexp_extract(a, f"(?is)\\bhref\\s*=\\s*({value})", 1), "^[\"']|[\"']$", "")
    label = lambda a: F.substring(decode_entities(F.regexp_replace(a, "(?s)<[^>]*>", " ")), 1, 120)
    return F.transform(found, lambda a: F.struct(absolute_url(decode_entities(href(a)), base).alias("href"), label(a).alias("text")))


def pick_subpages(found: Column, host: Column | str, most: int = 6) -> Column:
    """First distinct pages of a host whose path or link text promises staff or contacts; query and fragment cut."""
    own = lambda h: F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(h, "^(?i)https?://(?:[^/?#@]*@)?([^/?#]*)", 1)), ":\\d+$", ""), "^www\\.", "")
    path = lambda h: F.regexp_extract(h, "^(?i)https?://[^/?#]*([^?#]*)", 1)
    key = lambda h: F.regexp_replace(F.regexp_extract(h, "^(?i)(https?://[^?#]*)", 1), "/$", "")
    hint = "(?i)" + "|".join(SUBPAGE_HINTS)
    kept = F.filter(found, lambda x: x["href"].rlike("^(?i)https?://") & (own(x["href"]) == as_col(host)) & F.concat_ws(" ", path(x["href"]), x["text"]).rlike(hint))
    return F.slice(F.array_distinct(F.transform(kept, lambda x: key(x["href"]))), 1, most)


def emails(*sources: Column | str) -> Column:
    """Distinct addresses in order of appearance, lower case; file names, hashes, placeholders and no-reply boxes dropped."""
    found = F.concat(*[F.regexp_extract_all(text_of(s), F.lit(EMAIL), F.lit(0)) for s in sources])
    found = F.transform(found, lambda e: F.lower(e))
    junk = (
        "\\.(png|jpe?g|gif|svg|webp|css|js)$|^[0-9a-f]{16,}@|@(example|domain|yourdomain|email|sentry|sentry\\.io|wixpress|godaddy|squarespace|wix)\\."
        "|^(no-?reply|donotreply|postmaster|abuse|webmaster)@"
    )
    return F.array_distinct(F.filter(found, lambda e: ~e.rlike(junk)))


def mail_host(e: Column) -> Column:
    return F.when(e.contains("@"), F.split_part(e, F.lit("@"), F.lit(2))).otherwise("")


def mail_local(e: Column) -> Column:
    return F.split_part(e, F.lit("@"), F.lit(1))


def classify_emails(found: Column, domain: Column | str, name: Column | str) -> Column:
    """struct<shared, shared_all, direct>: addresses that belong to a site, own domain before free mail, split by role boxes."""

    def body(brands: Column) -> Column:
        d, apex = text_of(domain), last_two_labels(domain)
        label = lambda h: F.regexp_replace(F.regexp_replace(h, "\\.[a-z.]+$", ""), "[^a-z]", "")
        free = lambda e: mail_host(e).isin(*FREE_MAIL_SEEN)
        own = lambda e: (mail_host(e) == d) | (mail_host(e) == apex) | F.endswith(mail_host(e), F.concat(F.lit("."), apex))
        ours = lambda e: (mail_host(e) != "") & (own(e) | free(e) | F.exists(brands, lambda b: F.contains(label(mail_host(e)), b)))
        pool = F.filter(found, ours)
        ranked = F.concat(F.filter(pool, lambda e: ~free(e)), F.filter(pool, free))
        shared = lambda e: F.regexp_replace(mail_local(e), "[._-]", " ").isin(*SHARED_LOCALS)
        boxes = F.filter(ranked, shared)
        return F.struct(F.coalesce(F.get(boxes, 0), F.lit("")).alias("shared"), boxes.alias("shared_all"), F.filter(ranked, lambda e: ~shared(e)).alias("direct"))

    return let(brand_tokens(domain, name), body)


def people(text: Column | str) -> Column:
    """array<struct<first,last,title,rank>> of persons named next to a title, strongest title first, each once."""

    def body(t: Column) -> Column:
        each = []
        for rank, title in enumerate(TITLES):
            q = title.replace("-", "\\-")
            shapes = (f"({NAME})[ ]*[,|-]{{1,3}}[ ]*{q}\\b", f"{q}\\b[ ]*[:|-]{{1,3}}[ ]*({NAME})", f"({NAME})\\s*\\n\\s*{q}\\b")
            for shape in shapes:
                found = F.regexp_extract_all(t, F.lit(ascii_words(shape)), F.lit(1))
                each.append(F.transform(found, _named(title, rank)))
        none = F.array().cast("array<struct<name:string,title:string,rank:int>>")
        return F.when(t.rlike(any_word(TITLES)), F.concat(*each)).otherwise(none)

    def person(x: Column) -> Column:
        parts = F.split(x["name"], " ")
        return F.struct(F.get(parts, 0).alias("first"), F.get(parts, F.size(parts) - 1).alias("last"), x["title"].alias("title"), x["rank"].alias("rank"), F.size(parts).alias("n"), F.array_max(F.transform(parts, F.length)).alias("longest"), x["name"].alias("name"))

    bare = lambda w: F.length(F.regexp_replace(w, "\\.$", "")) >= 2
    words = ascii_words(f"(?i)\\b({'|'.join(NOT_A_NAME)})\\b")
    good = lambda p: (p["n"] >= 2) & (p["longest"] <= 20) & ~p["name"].rlike(words) & ~F.lower(p["first"]).isin(*NOT_A_FIRST_NAME) & bare(p["last"]) & bare(p["first"])
    key = lambda p: F.concat_ws(" ", F.lower(p["first"]), F.lower(p["last"]))

    def once(found: Column) -> Column:
        # the list runs by title rank, so the first of a name has its strongest title
        firsts = F.filter(found, lambda p, i: F.array_position(F.transform(found, key), key(p)) == i + 1)
        return F.transform(firsts, lambda p: F.struct(p["first"].alias("first"), p["last"].alias("last"), p["title"].alias("title"), p["rank"].alias("rank")))

    return let(let(let(normalize_separators(text_of(text)), body), lambda xs: F.filter(F.transform(xs, person), good)), once)


def _named(title: str, rank: int):
    return lambda n: F.struct(F.trim(F.regexp_replace(n, "\\s+", " ")).alias("name"), F.lit(title).alias("title"), F.lit(rank).alias("rank"))


def match_emails_to_people(found: Column, direct: Column) -> Column:
    """array<struct<first,last,title,rank,email>>: each person with the first address nobody before took that fits the name; '' if none."""

    def fits(e: Column, f: Column, n: Column) -> Column:
        lp = F.regexp_replace(F.lower(mail_local(e)), "[^a-z]", "")
        f1, n1 = F.substring(f, 1, 1), F.substring(n, 1, 1)
        whole = (lp == F.concat(f, n)) | (lp == F.concat(n, f)) | (lp == F.concat(f1, n)) | (lp == F.concat(f, n1))
        return (lp != "") & (whole | ((F.length(n) >= 4) & F.contains(lp, n)) | ((F.length(f) >= 4) & (lp == f)))

    def step(acc: Column, p: Column) -> Column:
        f, n = F.regexp_replace(F.lower(p["first"]), "[^a-z]", ""), F.regexp_replace(F.lower(p["last"]), "[^a-z]", "")
        hit = F.coalesce(F.get(F.filter(direct, lambda e: ~F.array_contains(acc["taken"], e) & fits(e, f, n)), 0), F.lit(""))
        row = F.struct(p["first"].alias("first"), p["last"].alias("last"), p["title"].alias("title"), p["rank"].alias("rank"), hit.alias("email"))
        return F.struct(F.when(hit != "", F.concat(acc["taken"], F.array(hit))).otherwise(acc["taken"]).alias("taken"), F.concat(acc["out"], F.array(row)).alias("out"))

    start = F.struct(NONE().alias("taken"), F.array().cast("array<struct<first:string,last:string,title:string,rank:int,email:string>>").alias("out"))
    return F.aggregate(found, start, step)["out"]


def guess_emails(first: Column | str, last: Column | str, domain: Column | str) -> Column:
    """Six patterns of an address, in order; six '' where a part is missing."""
    f, n, d = local_letters(first), local_letters(last), F.regexp_replace(F.lower(text_of(domain)), "^www\\.", "")
    at = F.concat(F.lit("@"), d)
    f1, n1 = F.substring(f, 1, 1), F.substring(n, 1, 1)
    six = F.array(F.concat(f, at), F.concat(f, F.lit("."), n, at), F.concat(f, n, at), F.concat(f1, n, at), F.concat(f1, F.lit("."), n, at), F.concat(f, n1, at))
    return F.when((f != "") & (n != "") & (d != ""), six).otherwise(F.array_repeat(F.lit(""), 6))


def _said(text: Column, words: str) -> Column:
    return text.rlike(ascii_words(f"(?i)\\b({words})\\b"))


def indoor_signals(text: Column | str) -> Column:
    """struct<indoor, outdoor, outdoor_only> of booleans."""
    t = text_of(text)
    return F.struct(_said(t, INDOOR).alias("indoor"), _said(t, OUTDOOR).alias("outdoor"), _said(t, "outdoor[-\\s]only").alias("outdoor_only"))


def sports(text: Column | str, profile: Profile = NY) -> Column:
    """Terms of the profile that occur anywhere in the text, in the profile's order."""
    t = F.lower(text_of(text))
    return F.filter(F.array(*[F.when(t.contains(s), F.lit(s)) for s in profile.sports]), lambda x: x.isNotNull())


def court_count(text: Column | str, profile: Profile = NY) -> Column:
    """struct<count, note>: the first count that a text states, by patterns in order, with 90 characters around it; count null if none."""
    number = f"(\\d{{1,3}}|{'|'.join(NUMBER_WORDS)})"
    forms = (f"{number}\\s+(?:indoor\\s+)?(?:{'|'.join(profile.sports)})\\s+courts?\\b", f"{number}\\s+indoor\\s+courts?\\b", f"{number}\\s+courts?\\b", f"courts?\\s*[:–—-]\\s*{number}\\b")
    values = F.create_map(*[F.lit(x) for kv in NUMBER_WORDS.items() for x in kv])

    def body(t: Column) -> Column:
        out = F.struct(F.lit(None).cast("int").alias("count"), F.lit("").alias("note"))
        for form in reversed(forms):
            p = ascii_words(f"(?i){form}")
            raw = F.lower(F.regexp_extract(t, p, 1))
            n = F.coalesce(raw.try_cast("int"), F.try_element_at(values, raw))
            whole = F.regexp_extract(t, p, 0)
            at = F.regexp_instr(t, F.lit(p)) - 1
            start = F.greatest(at - 90, F.lit(0))
            note = F.trim(F.substring(t, start + 1, at - start + F.length(whole) + 90))
            out = F.when((raw != "") & n.between(1, 200), F.struct(n.alias("count"), note.alias("note"))).otherwise(out)
        return out

    return let(one_line(text), body)


def first_rule(text: Column, rules, otherwise: str) -> Column:
    """Label of the first rule whose pattern is found: a decision list as one expression."""
    hits = [F.when(text.rlike(ascii_words(p if p in CASE_BOUND else f"(?i){p}")), F.lit(label)) for p, label in rules]
    return F.coalesce(*hits, F.lit(otherwise))


def facility_kind(name: Column | str, text: Column | str) -> Column:
    """Kind by the name, else by the name and the first 3000 characters of the text, else Unknown."""
    n = text_of(name)
    by_name = first_rule(n, NAME_KINDS, "")
    hay = F.concat(n, F.lit("\n"), F.substring(text_of(text), 1, 3000))
    return F.when(by_name != "", by_name).otherwise(let(hay, lambda h: first_rule(h, TEXT_KINDS, "Unknown")))


def excluded_by(name: Column | str, text: Column | str) -> Column:
    """The first exclusion pattern found in the name and the first 4000 characters of the text; '' if none."""
    hay = F.concat(text_of(name), F.lit("\n"), F.substring(text_of(text), 1, 4000))
    return let(hay, lambda h: first_rule(h, [(p.replace(".*", "[^\\n\\r]*") if p not in CASE_BOUND else p, p) for p in EXCLUDED], ""))


def looks_monetized(text: Column | str) -> Column:
    return _said(text_of(text), PAID)


def signal_count(text: Column | str, signals=RETAIL_SIGNALS) -> Column:
    """How many of the signals a text shows."""
    t = text_of(text)
    return sum((_said(t, s).cast("int") for s in signals), F.lit(0))


def looks_retail(text: Column | str) -> Column:
    return signal_count(text) >= 3


def page_title(html: Column | str) -> Column:
    """Name of a page's owner: the site name its metadata gives, else the first telling segment of its title; '' if neither."""

    def meta(h: Column, prop: str) -> Column:
        q = "[\"']"
        one = F.regexp_extract(h, f"(?i)<meta[^>]+(?:property|name)={q}{prop}{q}[^>]*content={q}([^\"']{{2,120}}){q}", 1)
        two = F.regexp_extract(h, f"(?i)<meta[^>]+content={q}([^\"']{{2,120}}){q}[^>]*(?:property|name)={q}{prop}{q}", 1)
        return decode_entities(normalize_separators(F.when(one != "", one).otherwise(two)))

    generic = lambda s: s.rlike(f"(?i){GENERIC_TITLES}")

    def body(h: Column) -> Column:
        tag = F.regexp_extract(h, "(?i)<title[^>]*>([^<]{2,160})</title>", 1)
        raw = F.when(tag != "", tag).otherwise(meta(h, "og:title"))
        clean = decode_entities(normalize_separators(raw))
        parts = F.filter(F.transform(F.split(clean, "\\s+[|–—-]\\s+"), lambda s: F.trim(s)), lambda s: s != "")
        named = F.get(F.filter(parts, lambda s: ~generic(s)), 0)
        return let(meta(h, "og:site_name"), lambda site: F.when((site != "") & ~generic(site), F.trim(site)).otherwise(F.trim(F.coalesce(named, F.get(parts, 0), clean))))

    return let(text_of(html), body)


STREET_WORD = ascii_words(f"(?i)\\b({'|'.join(STREET_WORDS)})\\b\\.?")


def addresses(text: Column | str, profile: Profile = NY) -> Column:
    """array<struct<street,city,zip>> of full street addresses of the state, each street and ZIP once."""
    state = f"(?:{profile.state}|{profile.state_name})"
    form = (
        f"(\\d{{1,6}}[A-Za-z]?\\s+[A-Za-z0-9.'`\\-\\s]{{2,40}}?(?:{'|'.join(STREET_SUFFIXES)})\\.?)(?:\\s*,?\\s*(?:Suite|Ste|Unit|Bldg|Building|Floor|Fl)\\.?\\s*[A-Za-z0-9_-]+)?"
        f"\\s*,\\s*([A-Z][A-Za-z.'\\-]*(?:\\s+[A-Z][A-Za-z.'\\-]*){{0,2}})\\s*,\\s*{state}\\b\\s*(\\d{{5}})?"
    )
    form = ascii_words(form)

    def body(t: Column) -> Column:
        part = lambda g: F.regexp_extract_all(t, F.lit(form), F.lit(g))
        rows = F.arrays_zip(part(1).alias("street"), part(2).alias("city"), part(3).alias("zip"))
        rows = F.transform(rows, lambda r: F.struct(F.trim(F.regexp_replace(r["street"], "\\s+", " ")).alias("street"), normalize_city(F.trim(r["city"]), profile.city_alias).alias("city"), F.coalesce(r["zip"], F.lit("")).alias("zip")))
        good = F.filter(rows, lambda r: F.length(r["city"]).between(3, 28) & ~r["city"].rlike(STREET_WORD) & (F.length(r["street"]) <= 60))
        key = lambda r: F.concat_ws("|", F.lower(r["street"]), r["zip"])
        return let(good, lambda g: F.filter(g, lambda r, i: F.array_position(F.transform(g, key), key(r)) == i + 1))

    return let(one_line(text), body)


def location_evidence(text: Column | str, profile: Profile = NY) -> Column:
    """How a text shows that it is about the state: address, zip, phone, mention or ''."""

    def body(t: Column) -> Column:
        phone = f"\\(?({'|'.join(profile.area_codes)})\\)?[)\\s.-]{{1,3}}\\d{{3}}[\\s.-]?\\d{{4}}"
        return (
            F.when(t.rlike(ascii_words(f"(?i),\\s*(?:{profile.state}|{profile.state_name})\\b")), "address").when(t.rlike(ascii_words(f"\\b{profile.state}\\s+{profile.zip_prefix}\\b")), "zip")
            .when(t.rlike(phone), "phone").when(t.rlike(ascii_words(f"(?i)\\b{profile.mention}\\b")), "mention").otherwise("")
        )

    return let(one_line(text), body)


def city_runs(text: Column | str, profile: Profile = NY) -> Column:
    """Words before ', NY' of every address line, what is left of a comma and of street words cut: array<string>, in order."""
    form = ascii_words(f"([A-Za-z][A-Za-z.'’\\- ]{{2,60}}?),\\s*(?:{profile.state}|{profile.state_name})\\b")
    runs = F.regexp_extract_all(one_line(text), F.lit(form), F.lit(1))

    def tail(words: Column) -> Column:
        last = F.aggregate(words, F.struct(F.lit(0).alias("i"), F.lit(0).alias("at")), lambda s, w: F.struct((s["i"] + 1).alias("i"), F.when(w.rlike(STREET_WORD), s["i"] + 1).otherwise(s["at"]).alias("at")))["at"]
        return F.array_join(F.slice(words, last + 1, F.size(words)), " ")

    return F.filter(F.transform(runs, lambda r: tail(F.filter(F.split(F.trim(r), "\\s+"), lambda w: w != ""))), lambda s: s != "")


def drop_name_artifacts(found: Column, name: Column | str) -> Column:
    """Persons both of whose names are words of the facility's own name are no persons."""
    words = F.filter(F.split(F.lower(text_of(name)), "[^a-z]+"), lambda w: w != "")
    return F.filter(found, lambda p: ~(F.array_contains(words, F.lower(p["first"])) & F.array_contains(words, F.lower(p["last"]))))


def own_direct_email(found: Column, direct: Column) -> Column:
    """The published address that echoes the first person's name; without a person, a single address is taken; else ''."""
    p = F.get(found, 0)
    f, n = F.lower(p["first"]), F.lower(p["last"])
    lp = lambda e: F.regexp_replace(mail_local(e), "[^a-z]", "")
    echo = F.get(F.filter(direct, lambda e: F.contains(lp(e), n) | (lp(e) == f) | F.startswith(lp(e), f)), 0)
    return F.coalesce(F.when(p.isNotNull(), echo).when(F.size(direct) == 1, F.get(direct, 0)), F.lit(""))


def notes(*sentences: tuple[Column, Column]) -> Column:
    """The sentences whose condition holds, in order, with a blank between; '' if none."""
    return F.concat_ws(" ", *[F.when(condition, text) for condition, text in sentences])


def name_is_confirmed(first: Column | str, last: Column | str) -> Column:
    """Whether both names are letters, two or more, and neither an honorific nor a squad or department."""
    from pagelode.profile import HONORIFICS, NOT_A_PERSON

    def ok(c: Column) -> Column:
        t = F.trim(text_of(c))
        bare = F.regexp_replace(t, "(?i)['’]s$", "")
        return t.rlike("^[A-Za-z][A-Za-z'’.-]*$") & (F.length(F.regexp_replace(t, "[^A-Za-z]", "")) >= 2) & ~bare.rlike(f"(?i)^({'|'.join(HONORIFICS)})\\.?$") & ~F.lower(bare).isin(*NOT_A_PERSON)

    return ok(as_col(first)) & ok(as_col(last))


def looks_like_publisher(name: Column | str, domain: Column) -> Column:
    """Whether a host or a name is a newspaper's, a station's or an aggregator's; never without a host."""
    from pagelode.profile import MASTHEADS, PUBLISHER_DOMAINS, VENUE_WORDS, WEAK_MASTHEADS

    n = text_of(name)
    host = F.exists(F.array(*[domain.rlike(f"(?i){p}") for p in PUBLISHER_DOMAINS]), lambda x: x)
    by_name = n.rlike("^\\d{2,3}\\.\\d") | n.rlike(ascii_words(f"(?i){MASTHEADS}")) | (n.rlike(ascii_words(f"(?i){WEAK_MASTHEADS}")) & ~n.rlike(ascii_words(f"(?i){VENUE_WORDS}")))
    return (domain != "") & (host | by_name)
