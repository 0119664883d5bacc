"""Names typed by people, taken apart: facilities, persons, hosts and the lexicons they need.

Plain Python over distinct texts, run in Arrow batches; every function gives '' or empty lists for what a text lacks.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

# Words of the trade that name a kind of facility and not the facility.
KIND_WORDS = (
    "racquet", "club", "indoor", "sports", "complex", "recreation", "association", "fieldhouse", "country", "pickleball", "health", "athletic",
    "center", "padel", "hall", "tennis", "squash", "fitness", "community", "sportsplex", "volleyball",
)
# Short forms that are no beginnings or skeletons of the word.
KIND_SHORT = {"pb": "pickleball", "pball": "pickleball", "vball": "volleyball", "fh": "fieldhouse", "plex": "sportsplex", "racket": "racquet", "rqt": "racquet", "centre": "center", "assn": "association", "gym": "fitness", "ctr": "center", "cplx": "complex"}
KIND_BIT = {w: 1 << i for i, w in enumerate(KIND_WORDS)}
GENERIC = {"club", "center", "sports", "indoor", "hall", "association", "complex"}
DECOR = (
    r"^\W*(?:welcome to|home of|home)\b\W*", r"\W+official(?: site)?\W*$", r"\W+(?:indoor|ind\.?) courts?\W*$", r"\W+courts\W*$", r"\W+(?:home|homepage)\W*$",
    r",? +(?:inc|llc|l\.l\.c|corp|co|ltd|incorporated|limited)\b\.?(?=\W*$|\W+[|–-])", r", ny\b", r"\bn\.y\.",
)
NOT_NAMES = {"welcome", "official", "home", "site", "courts", "court", "corp", "unit", "number", "ball"}
UNIT = re.compile(r"(?:#|\bno\.?|\bnr\.?|\bunit|\bsite|\bnumber|\bnum\.?) *0*([0-9]+)\b|\(0*([0-9]+)\)|\b0*([0-9]{1,4})\b")
# Public mail services; what else nobody owns is found in the data.
FREE_MAIL = {"gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "aol.com", "icloud.com"}
MEMO = 200_000  # texts a worker remembers the reading of; then it starts anew, so its memory is bounded and its output the same
PAGES = {"", "contact", "courts", "index.html", "about", "staff", "home", "index.htm", "index.php"}
# Given names and their short forms, public knowledge of English usage.
NICKNAMES = {
    "abigail": "abby gail", "alexander": "alex al xander sandy sasha", "alexandra": "alex lexi sandra", "andrew": "andy drew", "anthony": "tony ant", "benjamin": "ben benny benji",
    "beatriz": "bea bia betty", "catherine": "cathy kate cat", "charles": "charlie chuck chas chad", "christian": "chris", "christine": "chris chrissy tina christy kristy", "christopher": "chris topher kit", "daniel": "dan danny",
    "david": "dave davey", "deborah": "deb debbie debra", "dorothy": "dot dottie dolly", "edward": "ed eddie ted ned edw", "elizabeth": "liz beth eliza betty lizzie betsy", "emily": "em emmy",
    "francisco": "paco pancho fran frank cisco", "frederick": "fred freddie", "gerald": "gerry jerry", "gregory": "greg", "henry": "hank harry", "jacob": "jake", "james": "jim jimmy jamie", "jennifer": "jen jenny jenn",
    "jessica": "jess jessie", "john": "jack johnny", "jonathan": "jon", "joseph": "joe joey jos", "josephine": "jo josie josey", "joshua": "josh", "julian": "jules", "katherine": "kate kathy katie kat kathie kitty kay", "kenneth": "ken kenny",
    "lawrence": "larry", "leonard": "len lenny leo", "margaret": "meg maggie peggy marge", "martin": "marty", "matthew": "matt matty", "michael": "mike mick mikey", "michelle": "shelly", "nathaniel": "nate nat",
    "nicholas": "nick nicky", "patricia": "pat patty tricia trish", "patrick": "pat paddy", "peter": "pete", "philip": "phil", "rebecca": "becky becca", "richard": "rick dick rich ricky richie", "robert": "bob rob bobby robbie robt",
    "ronald": "ron ronnie", "rosalind": "roz rosie", "samantha": "sam sammy", "samuel": "sam sammy", "stephanie": "steph stephie", "stephen": "steve stevie", "steven": "steve stevie", "susan": "sue susie suzie suzy",
    "theodore": "ted theo teddy", "thomas": "tom tommy thos", "timothy": "tim timmy", "victoria": "vicky vicki tori", "victor": "vic", "vincent": "vince vinny", "william": "bill will billy willie liam wm", "zachary": "zach zack",
}
HONOR = {"mr", "mrs", "ms", "mx", "dr", "prof", "coach", "miss", "sir", "rev", "pro"}
AFTER = {"jr", "sr", "ii", "iii", "iv", "ccp", "mba", "phd", "pga", "uspta", "ppr", "cpa", "esq", "md", "rn"}
PARTICLES = {"de", "la", "vander", "dela", "van", "der", "el", "saint", "von", "del", "di", "du", "st"}


def memo(f: Callable) -> Callable:
    """f of one text, remembering up to MEMO results."""
    seen: dict = {}

    def run(x):
        if x not in seen:
            if len(seen) >= MEMO:
                seen.clear()
            seen[x] = f(x)
        return seen[x]

    return run


def _accents() -> dict[int, str]:
    out = {}
    for cp in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(cp))[0]
        if base.isascii():
            out[cp] = base
    return out | {0x2019: "'", 0x2018: "'", 0x00A0: " ", 0x200B: "", 0x2009: " ", 0x202F: " "}


_PLAIN = _accents()


def unmangle(s: str) -> str:
    """UTF-8 read as windows-1252 undone, wholly or piece by piece."""
    if not re.search("[ÃâÂ]", s):
        return s

    def part(m: re.Match) -> str:
        try:
            return m[0].encode("cp1252").decode("utf-8")
        except (UnicodeDecodeError, UnicodeEncodeError):
            return m[0]

    return re.sub("Ã.|Â.|â..", part, s)


def plain(s: str | None) -> str:
    return " ".join(unmangle(s).replace("&amp;", "&").translate(_PLAIN).lower().split()) if s else ""


def no_digits(w: str) -> str:
    """0 and 1 typed for o and l within a word."""
    return w.replace("0", "o").replace("1", "l") if re.search("[a-z]", w) and re.fullmatch("[a-z01]*", w) else w


def cuts(w: str, depth: int) -> Iterator[tuple[str, int]]:
    """w and what is left after up to depth deletions, with their number."""
    seen = {w: 0}
    level = [w]
    for n in range(1, depth + 1):
        nxt = []
        for x in level:
            for i in range(len(x)):
                y = x[:i] + x[i + 1 :]
                if y not in seen:
                    seen[y] = n
                    nxt.append(y)
        level = nxt
    return iter(seen.items())


def depth_of(w: str) -> int:
    return 2 if len(w) >= 7 else 1 if len(w) >= 4 else 0


class Near:
    """Words of a lexicon by their deletions; lookup gives the nearest word and its distance."""

    def __init__(self, words: Iterable[str]):
        self.words, self.at = set(words), {}
        for w in sorted(self.words):
            for v, n in cuts(w, depth_of(w)):
                self.at.setdefault(v, []).append((w, n))
        self.find = memo(self._find)

    def _find(self, t: str) -> tuple[str, int] | None:
        if t in self.words:
            return t, 0
        best = None
        for v, n in cuts(t, depth_of(t)):
            for w, m in self.at.get(v, ()):
                d = max(n, m)
                if d <= min(depth_of(t), depth_of(w)) and (best is None or (d, w) < (best[1], best[0])):
                    best = (w, d)
        return best


def skeleton(t: str, w: str) -> bool:
    """t keeps the first letter of w and letters of w in order."""
    if not t or t[0] != w[0] or len(t) >= len(w) or len(t) < 2 or len(t) / len(w) < 0.2:
        return False
    it = iter(w)
    return all(c in it for c in t)


class Lexicon:
    """Cities and common words, as the parsers need them. cities: (id, name); common: words frequent in the corpus that stay as they are."""

    def __init__(self, cities: Iterable[tuple[int, str]], common: Iterable[str] = ()):
        self.entries = [(int(i), [w for w in re.split("[^a-z]+", plain(n)) if w]) for i, n in cities]
        df: dict[str, int] = {}
        for _, ws in self.entries:
            for w in set(ws):
                df[w] = df.get(w, 0) + 1
        self.content: dict[str, list[tuple[int, list[str]]]] = {}
        for i, ws in self.entries:
            if ws:
                self.content.setdefault(min(ws, key=lambda w: (df[w], -len(w))), []).append((i, ws))
        self.side = {w for _, ws in self.entries for w in ws} - set(self.content)
        self.near_side = Near(w for w in self.side if len(w) >= 4)
        self.near_city = Near(w for w in self.content if len(w) >= 5)
        self.near_kind = Near(KIND_WORDS)
        self.common = {w for w in common if len(w) > 3 and w not in KIND_WORDS and w not in NOT_NAMES}
        self.near_common = Near(w for w in self.common if w not in self.content and w not in self.side)
        self.kind = memo(self._kind_of)

    def _kind_of(self, t: str) -> str:
        if t in KIND_SHORT:
            return KIND_SHORT[t]
        if t in KIND_WORDS:
            return t
        hit = self.near_kind.find(t)
        if t in self.common and re.search("[aeiouy]", t[1:]) and not (hit and hit[1] <= 1):
            return ""
        if hit:
            return hit[0]
        if len(t) >= 3 and (starts := [w for w in KIND_WORDS if w.startswith(t)]):
            return min(starts, key=len)
        if len(t) <= 7 and (like := [w for w in KIND_WORDS if skeleton(t, w)]):
            return min(like, key=len)
        return ""

    def city(self, words: list[str], whole: bool = False) -> tuple[int, list[int]]:
        """(id, positions) of the city named by words, 0 if none; whole: words are nothing but a city, so cut words count."""
        for at in range(len(words) - 1, -1, -1):
            w = words[at]
            hit = self.near_city.find(w) if len(w) >= 5 and (w in self.content or w not in self.common) else None
            if not hit and whole and len(w) >= 5 and (c := [x for x in self.content if x.startswith(w)]) and len(c) == 1:
                hit = (c[0], 1)
            if hit:
                options = self.content[hit[0]]
                rest = set(words)
                best = max(options, key=lambda o: (sum(any(x == y or y.startswith(x) or skeleton(x, y) for x in rest) for y in o[1]), -len(o[1]), -o[0]))
                used = [at] + [k for k in (at - 1, at + 1) if 0 <= k < len(words) and any(words[k] == y or (y in self.side and (y.startswith(words[k]) or skeleton(words[k], y) or (self.near_side.find(words[k]) or ("",))[0] == y)) for y in best[1] if y != hit[0])]
                return best[0], sorted(used)
        return 0, []


def words_of(s: str) -> list[str]:
    return [no_digits(w) for w in re.split("[^a-z0-9]+", s.replace("'", "")) if w]


def parse_facility(raw: str | None, lex: Lexicon) -> dict:
    """core: words of the name proper; kinds: kind words in canonical form; unit: number of a branch; city: id of the city in the name; initials: of an abbreviated name."""
    s = unmangle(raw or "")
    s = re.sub(r"(?<=[a-zé])(?=[A-Z][a-zé]{2})(?<!Mc)", " ", s)
    s = plain(s)
    s = re.sub(r"^\W*the\b", " ", s)
    for _ in range(2):
        for p in DECOR:
            s = re.sub(p, " ", s)
    s = re.sub(r"^\W*the\b", " ", s)
    s = re.sub(r"\bpickle ball\b", "pickleball", re.sub(r"\bfield house\b", "fieldhouse", s))
    s = re.sub(r"\bp-ball\b", "pickleball", re.sub(r"\bv-ball\b", "volleyball", s))
    initials = ""
    if m := re.search(r"\b(?:[a-z]\.){2,}[a-z]?", s):
        initials, s = re.sub("[^a-z]", "", m[0]), s[: m.start()] + " " + s[m.end() :]
    unit = ""
    if m := UNIT.search(s):
        unit, s = (m[1] or m[2] or m[3]).lstrip("0") or "0", s[: m.start()] + " " + s[m.end() :]
    ws, city = words_of(s), 0
    town = ""
    for _ in range(3):
        at, used = lex.city(ws[1:]) if len(ws) > 1 else (0, [])
        if not at:
            break
        if not city:
            city, town = at, "".join(ws[k + 1][0] for k in used)
        ws = [w for k, w in enumerate(ws) if k - 1 not in used]
    if len(ws) == 1 and len(ws[0]) <= 7 and re.search(r"\b" + ws[0].upper() + r"\b", raw or "") and not initials and not unit:
        return {"core": [], "kinds": [], "unit": "", "city": city, "initials": ws[0], "acro": ws[0], "acro_town": ws[0]}
    core, kinds, acro = [], [], "".join(w[0] for w in ws if w not in ("and", "of", "the"))
    for k, w in enumerate(ws):
        if w in ("and", "of", "the", "a", "at", "ny") or w in NOT_NAMES:
            continue
        kd = lex.kind(w) if len(w) > 1 else ""
        if kd and not (k == 0 and len(w) > 6 and kd != w and not any(lex.kind(x) for x in ws[1:])):
            kinds.append(kd)
        elif len(w) == 1:
            initials += w
        else:
            near = lex.near_common.find(w) if len(w) > 3 and w not in lex.common else None
            # what tells names apart comes first and is no mistyped common word, unless it is as good as one
            core.append(near[0] if near and (core or (near[1] <= 1 and len(w) >= 8)) else w)
    while len(core) > 2 and core[-1] in lex.side:  # what is left of a city that was cut off
        core.pop()
    # a chain's name is all common words; its short forms stand for the longest of them
    if len(core) > 1:
        long = [max((c for c in lex.common if c.startswith(w)), key=lambda c: (len(c), c), default=w) if len(w) >= 3 else w for w in core]
        if all(w in lex.common for w in long):
            core = long
    if "sports" in kinds and "plex" in kinds:
        kinds = [x for x in kinds if x not in ("sports", "plex")] + ["sportsplex"]
    if len(core) == 1 and len(core[0]) >= 9 and core[0] not in lex.common:
        for cut in range(len(core[0]) - 3, 4, -1):
            if core[0][cut:] in lex.common and core[0][cut:] not in KIND_WORDS:
                core = [core[0][:cut], core[0][cut:]]
                break
    return {"core": core, "kinds": sorted(set(kinds)), "unit": unit, "city": city, "initials": initials, "acro": acro, "acro_town": acro + town}


HOST_ENDS = (*KIND_WORDS, "cc", "rec", "volley", "indoor", "club", "ny")


def core_of_host(host: str, lex: Lexicon) -> list[str]:
    """First word and common last word of the name that a host was made of; [] if it does not show them."""
    base = host.split("-")[0]
    for e in sorted(HOST_ENDS, key=lambda e: (-len(e), e)):
        if base.endswith(e) and len(base) - len(e) >= 8:
            base = base[: -len(e)]
            break
    for cut in range(5, len(base) - 2):
        if base[cut:] in lex.common and base[cut:] not in KIND_WORDS:
            return [base[:cut], base[cut:]]
    return []


def complete(p: dict, host: str, lex: Lexicon) -> dict:
    """A name in initials, or of one word, filled from the host where that begins with the same word."""
    if host and (p["initials"] or len(p["core"]) < 2) and not p["unit"]:
        core = core_of_host(host, lex)
        if core and (not p["core"] or (len(p["core"][0]) > 3 and Near([core[0]]).find(p["core"][0]))):
            return p | {"core": core, "initials": ""}
    return p


def parse_host(website: str | None, email_domain: str | None, emails: Iterable[str | None] = (), free: Iterable[str] = FREE_MAIL) -> tuple[str, str]:
    """(host, slug): label of the facility's own host without its ending; page name on a listing host."""
    host, slug = "", ""
    m = re.match(r"^(?:https?:/{1,2})?(?:[^/@]*@)?([a-z0-9.-]+\.[a-z]+)(?::\d+)?(?:/([^?#]*))?", plain(website))
    if m:
        h, p = re.sub(r"^(?:(?:www|m|book)\.)+", "", m[1]), (m[2] or "").strip("/")
        if p in PAGES:
            host = h
        else:
            slug = re.sub("[^a-z0-9]", "", p)
    d = plain(email_domain)
    if not host and "." in d and d not in free:
        host = d
    for e in emails:
        local, _, dom = plain(e).partition("@")
        if dom in free:
            slug = slug or re.sub("(?:courts|ny)$", "", re.sub("[^a-z0-9]", "", local))
    return re.sub(r"\.[a-z]+$", "", host), slug


GIVEN = {n: full for full, short in NICKNAMES.items() for n in short.split()}


def parse_person(raw: str | None) -> tuple[list[str], list[str]]:
    """(given, family) words as typed, order repaired where a comma or particles show it; single letters stay as initials."""
    s = plain(raw)
    s = re.sub(r"\s[-–—|*(/;].*$", "", s)
    s = re.sub(r",[^,]*/.*$", "", s)
    s = re.sub(r"[*\"()]", " ", s)
    head, _, tail = s.partition(",")
    tw = [] if "/" in tail else [w for w in re.split(r"[^a-z']+", tail) if w and w not in AFTER]
    clean = lambda x: [w.replace("'", "") for w in re.split(r"[\s.,]+", x) if w.strip(".'-") and w.strip(".") not in HONOR | AFTER]
    if tw:
        return [w for w in clean(tail) if "-" not in w], _family(clean(head))
    ws = clean(head)
    if not ws:
        return [], []
    if len(ws) == 1:
        return [], _family(ws)
    k = next((i for i, w in enumerate(ws) if w in PARTICLES), None)
    if k == 0:
        return [ws[-1]], _family(ws[:-1])
    return ws[:1], _family([w for w in ws[1:] if len(w) > 1])


def _family(ws: list[str]) -> list[str]:
    return [w for x in ws for w in x.split("-") if w]


class Titles:
    """Job titles by the entry of a list they come nearest to; '' where none fits."""

    def __init__(self, entries: Iterable[str], synonyms: dict[str, str], fillers: Iterable[str] = ()):
        self.entries = [(n, [w for w in re.split("[^a-z]+", plain(n)) if w and w not in ("of", "and", "the")]) for n in entries]
        self.df: dict[str, int] = {}
        for _, ws in self.entries:
            for w in set(ws):
                self.df[w] = self.df.get(w, 0) + 1
        self.short: dict[str, list[str]] = {}
        for _, ws in self.entries:
            if len(ws) > 1:
                self.short.setdefault("".join(w[0] for w in ws), []).append(" ".join(ws))
        self.near, self.syn, self.fillers = Near(self.df), synonyms, {"of", "the", *fillers}
        self._best = memo(self._best_of)

    def _read(self, t: str) -> set[str]:
        if t in self.df:
            return {t}
        if t in self.syn:
            return {self.syn[t]}
        if len(self.short.get(t, ())) == 1:
            return set(self.short[t][0].split())
        if hit := self.near.find(t):
            return {hit[0]}
        return {w for w in self.df if (w.startswith(t) and len(t) >= 3) or (len(t) <= 8 and skeleton(t, w))}

    def key(self, raw: str | None) -> str:
        return self._best(re.sub(r"(?<=\b[a-z])\.(?=[a-z]\b)", "", plain(raw)))

    def _best_of(self, s: str) -> str:
        said = [self._read(w) for w in re.split("[^a-z]+", s.replace("'", "").replace("co-ord", "coord")) if w and w not in self.fillers]
        best = ("", 0.0)
        for n, ws in self.entries:
            got = sum(1 / self.df[w] for w in ws if any(w in x for x in said))
            all_ = sum(1 / self.df[w] for w in ws)
            lost = sum(0.5 for x in said if not x & set(ws))
            if got / (all_ + lost) > best[1]:
                best = (n, got / (all_ + lost))
        return best[0] if best[1] >= 0.5 else ""
